import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import edge_docs, no_docs

from wardflow.llm import alignment
from wardflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


class Whole:
    """Alignment of whole texts with the libraries, by sets of ends."""

    def __init__(self):
        import public_tokenizers as files
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.path("piece_bpe_32k.model"))
        letters = alignment.byte_characters()
        self.a_bytes = [bytes(letters[c] for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        parts = [[self.a_bytes[i] for i in a], [self.b_bytes(i) for i in b]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return None
        ends = [np.cumsum(list(map(len, p))).tolist() for p in parts]
        place = [{e: k for k, e in enumerate(own)} for own in ends]
        links = [(place[0][e], place[1][e]) for e in sorted(set(ends[0]) & set(ends[1]))]
        groups, i, j = [], 0, 0
        for x, y in links:
            groups.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
            i, j = x + 1, y + 1
        return len(a), len(b), [(a[x], b[y]) for x, y in links], ";".join(groups)


def expected(texts):
    """A row per text, as ``aligned`` gives it without the id."""
    whole = Whole()
    found = [whole.align(t) for t in texts]
    counts = Counter(p for f in found if f for p in f[2])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(f[0], f[1], len(f[2]), len(f[2]), sum(counts[p] == best[p[1]] for p in f[2]), sum(counts[p] for p in f[2]), f[3])
            if f else (0, 0, 0, 0, 0, 0, "") for f in found]


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), *e) for r, e in zip(rows, expected([r["text"] for r in rows])))
    got = alignment.aligned(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert alignment.aligned(no_docs(spark)).count() == 0


TEXTS = ["a", " ", "  ", " a", "a ", "a  ", "a   b", "\n", "a\n b", "a\n\n  b", "a \n b", "x\t y", "don't  we'll", "<|endoftext|> </s> <0x41>",
         "an ▁ mark", "no\u00a0break\u00a0 space", "　wide 　 space", "日本語 テキスト", "😀 😀", "e\u0301 é", "\x00 \x1c \x85 x", "\ufeff x\u200b y",
         "12345 67,890.12", "==== ####", "A" * 3000, " " * 3000 + "x", "word " * 50 + "end"]


def test_words_encode_like_whole_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in alignment.aligned(docs, words_kept=30).collect()}
    for i, want in enumerate(expected(TEXTS)):
        assert got[i] == want, TEXTS[i][:20]
    assert got[TEXTS.index("an ▁ mark")] == (0, 0, 0, 0, 0, 0, "")


def test_query_equals_whole_text_alignment(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = expected([r["text"] for r in rows])
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_alignment"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, w in zip(rows, want):
        assert got[r["doc_id"]] == (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "")


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_verifies(n):
    keys = np.random.default_rng(n).choice(1 << 40, size=n, replace=False).astype(np.int64)
    index = alignment.PerfectHash(keys)
    assert sorted(index.numbers(keys).tolist()) == list(range(n))
    others = np.setdiff1d(np.arange(5000, dtype=np.int64), keys)
    assert (index.numbers(others) == -1).all()


def test_tree_sum_of_dense_vectors(spark):
    keys = np.arange(0, 30_000, 3, dtype=np.int64)
    index = alignment.PerfectHash(keys)
    pairs = spark.range(0, 90_000).selectExpr("(id % 10000) * 3 as key", "id % 7 as n").repartition(20)
    want = np.zeros(-(-len(keys) // alignment.BLOCK) * alignment.BLOCK, np.int64)
    np.add.at(want, index.numbers((np.arange(90_000) % 10_000) * 3), np.arange(90_000) % 7)
    got = alignment.summed(pairs, spark.sparkContext.broadcast(index), fan=3).collect()
    assert sorted(r["block"] for r in got) == list(range(len(want) // alignment.BLOCK))
    for r in got:
        k = r["block"] * alignment.BLOCK
        assert (np.frombuffer(r["counts"], "<i8") == want[k:k + alignment.BLOCK]).all()


def test_pairs_are_bounded_by_the_vocabularies(spark):
    counts = alignment.pair_counts(spark.read.parquet(f"{SF}/documents.parquet"))
    assert 0 < counts.index.size <= alignment.most_pairs() < 1_000_000
