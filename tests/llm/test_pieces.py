import random

import numpy as np
import pytest
from llm_rows import edge_docs, no_docs, prose

from wardflow.llm import pieces

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as files
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=files.path(MODEL))


@pytest.fixture(scope="module")
def merges():
    return pieces.Merges(pieces.Merges.parts(MODEL))


ODD = ["", " ", "  ", "     end", "  Hello  world\tfoo\nbar ▁x 　ﬁ é é \x00 😀\n\n  end  ", "a" * 700, "日本語のテキスト、漢字。" * 9,
       "<s> </s> <0x41> <unk>", "▁▁▁▁▁▁x ▁▁▁▁▁", "    " * 9 + "q", "123456 7890 3.14", "ABCabcABC", "́̂ x", "ꙮ꙰ 𐍈𐍉",
       "https://www.example.com/a/b?c=d&e=f", "don't", "\r\n\r\n", "ñandú çà è ß"]


@pytest.mark.parametrize("portion", [64, 1 << 19])
def test_ids_equal_the_library(library, merges, portion):
    rnd = random.Random(1)
    texts = ODD + [prose(i, rnd.randint(1, 80)) for i in range(50)]
    texts += ["".join(rnd.choice(" aeinrst▁éü0\n") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    encoder = pieces.UnitEncoder(merges, portion=portion, stored=500)
    got = [x.tolist() for k in range(0, len(texts), 37) for x in encoder.texts(texts[k:k + 37])]
    assert got == library.encode(texts)
    back = pieces.decoder(merges)
    assert [back(x) for x in got] == [library.decode(x) for x in got]
    assert [back(x) for x in got] == [t.replace("▁", " ") for t in texts]


def test_suffix_array_and_ranges():
    rnd = random.Random(2)
    text = "".join(rnd.choice("abc") for _ in range(300)) + "\0"
    codes = np.array([ord(c) for c in text], dtype=np.int32)
    order = pieces.suffix_array(codes, 6)
    assert [text[i:i + 6] for i in order] == sorted(text[i:i + 6] for i in range(len(text)))
    wanted = ["a", "ab", "abc", "cba", "aaaa", "bcbcb", "z"]
    patterns = np.zeros((len(wanted), 6), dtype=np.int32)
    for k, w in enumerate(wanted):
        patterns[k, :len(w)] = [ord(c) for c in w]
    low, high = pieces.occurrence_ranges(codes, order, patterns, np.array([len(w) for w in wanted]))
    for w, lo, hi in zip(wanted, low, high):
        assert sorted(order[lo:hi]) == [i for i in range(len(text)) if text.startswith(w, i)]


def test_borders_equal_the_merges(merges):
    ranks = {}
    for key, rank in zip(merges.pair_keys.tolist(), merges.pair_ranks.tolist()):
        a, b = divmod(key, len(merges.names))
        ranks[merges.names[a] + merges.names[b]] = rank
    rnd = random.Random(3)
    some = [i for i in range(259, 32000) if len(merges.names[i]) <= 6]
    a, b = (np.array([rnd.choice(some) for _ in range(1500)] + [259, 260, 259, 259]),
            np.array([rnd.choice(some) for _ in range(1500)] + [259, 259, 260, 261]))
    got = merges.keeps(a, b)
    for x, y, kept in zip(a, b, got):
        x, y = merges.names[x], merges.names[y]
        assert kept == (pieces.merged(list(x + y), ranks) == [x, y]), (x, y)


def test_edge_rows(spark, library):
    docs = edge_docs(spark)
    rows = pieces.roundtrip(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count() and all(r["same"] for r in rows)
    for r in rows:
        if r["doc_id"] is not None:
            assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(texts[r["doc_id"]] or "")
    assert pieces.roundtrip(no_docs(spark)).count() == 0
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(docs.filter("doc_id > 3"))).collect()}
    assert back == {i: (t or "") for i, t in texts.items() if i and i > 3}
