import random
import zlib

import numpy as np
import pytest
from llm_rows import edge_docs, edge_texts, no_docs

from wardflow.llm import packing


def reference_ids(text):
    import public_tokenizers as files
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(pieces, ids_by_doc, window=2048):
    """Each id in one piece, gapless sequences, right ids."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    for doc, ids in ids_by_doc.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            part = np.array(ids[at:at + p["length"]], dtype="<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids)
    assert set(by_doc) == set(ids_by_doc)
    return by_seq


def test_edge_rows(spark):
    texts = {}
    docs = edge_docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    for r in docs.collect():
        texts[r["doc_id"]] = reference_ids(r["text"])
    check_pieces(packing.piece_digests(packing.pack(docs)).collect(), texts)
    again = packing.pack(edge_docs(spark)).groupBy().sum("length").first()[0]
    assert again == sum(len(reference_ids(t)) for _, t, _, _ in edge_texts())
    assert packing.pack(no_docs(spark)).count() == 0


def test_both_libraries_agree():
    encode = packing.Encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    for text in ["a" * 5000, " " * 3000 + "x", "x" + "\n " * 2000, "<|endoftext|>", "don't  stop\t\n", "ﬁ é 日本 😀" * 400,
                 "word " * 3000, "　" * 1500 + "y"]:
        assert encode(text) == reference_ids(text)[:-1], text[:20]


@pytest.mark.parametrize("max_open", [3, 4096])
def test_packer_invariants(max_open):
    rnd = random.Random(4)
    packer, parts, want = packing.SumOfSquares(100, 7, max_open), [], {}
    for item in range(2000):
        want[item] = rnd.choice([1, 7, 33, 50, 99])
        parts += packer.place(item, want[item])
        assert packer.n_open == packer.levels.sum() <= max_open
    parts += packer.finish()
    by_item, by_seq = {}, {}
    for item, start, length, sequence, offset, closed_by in parts:
        by_item.setdefault(item, []).append((start, length))
        by_seq.setdefault(sequence, []).append((offset, length, closed_by))
    for item, size in want.items():
        at = 0
        for start, length in sorted(by_item[item]):
            assert start == at
            at += length
        assert at == size
    for own in by_seq.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= 100 and len({c for _, _, c in own}) == 1
    assert len(by_seq) == -(-sum(want.values()) // 100)  # no padding but in the last
    assert min(by_seq) == 7
    if max_open > 3:
        assert sum(p[2] for p in parts if p[5] == "placement") > 0.6 * sum(want.values())


def test_few_packers_see_the_items_of_many_tasks(spark):
    """At 24 tasks most tokens are in windows that placement closed, or whole ones."""
    items = spark.range(0, 30_000).selectExpr("id as item", "1 + pmod(xxhash64(id), 255) as length").repartition(24)
    placed = packing.place_items(items, 1, 256, 1 << 18)
    share = {r["closed_by"]: r["tokens"] for r in placed.groupBy("closed_by").agg({"length": "sum"}).withColumnRenamed("sum(length)", "tokens").collect()}
    assert share["placement"] > 0.8 * sum(share.values())
    again = packing.place_items(items.repartition(5), 1, 256, 1 << 18)
    assert placed.exceptAll(again).isEmpty() and again.exceptAll(placed).isEmpty()
    three = packing.place_items(items, 3, 256, 1 << 18)
    assert three.selectExpr("sequence_id >> 40 as packer").distinct().count() == 3
    assert three.groupBy("item").sum("length").join(items, "item").where("length <> `sum(length)`").isEmpty()


def test_query_equals_the_library(spark):
    """Every piece of the whole table, its ids by the tokenizer's own library."""
    from wardflow.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    ids = {r["doc_id"]: reference_ids(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    by_seq = check_pieces(QUERIES["op2_pack"](spark, sf).collect(), ids)
    tokens = sum(map(len, ids.values()))
    assert len(by_seq) <= tokens // 2048 + 2


def test_best_level_is_the_smallest_sum_of_squares():
    rnd = random.Random(5)
    packer = packing.SumOfSquares(20, 0, 10**6)
    for _ in range(500):
        packer.levels = np.array([0] + [rnd.choice([0, 0, 1, 2, 5]) for _ in range(19)] + [0])
        size = rnd.randint(1, 19)
        best = None
        for h in range(0, 20 - size + 1):
            if h and not packer.levels[h]:
                continue
            counts = packer.levels.copy()
            counts[h] -= h > 0
            if h + size < 20:
                counts[h + size] += 1
            cost = int((counts ** 2).sum())
            if best is None or cost <= best[0]:
                best = (cost, h)
        assert packer.best_level(size) == best[1]
