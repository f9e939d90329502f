import math
import random

import numpy as np
import pandas as pd
from llm_rows import edge_docs, no_docs
from pyspark.sql import functions as F

from wardflow.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["str", "eng", "oth", "ir"], "cc": ["éau", "çon", "ñi", "ux"]}


def text_of(lang, seed, n=80):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def counts_of(texts, order):
    rows = {}
    for lang, text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        for depth in range(order + 1):
            for context, byte in zip(language.context_codes(data, depth).tolist(), data.tolist()):
                key = (lang, depth, context, byte)
                rows[key] = rows.get(key, 0) + 1
    return pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["lang", "depth", "context", "byte", "n"])


def brute_length(counts, lang, text, order):
    """Escapes one by one, with dictionaries."""
    table = {}
    for r in counts.itertuples():
        if r.lang == lang:
            table.setdefault((r.depth, r.context), {})[r.byte] = r.n
    known = {(r.depth, r.context) for r in counts.itertuples()}

    def share(depth, context, byte):
        if depth < 0:
            return 1 / 256
        seen = table.get((depth, context))
        shorter = lambda b: share(depth - 1, context & ((1 << 8 * max(0, depth - 1)) - 1), b)
        if not seen:
            return shorter(byte)
        n, d = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (n + d)
        return d / (n + d) * shorter(byte) / (1 - sum(shorter(b) for b in seen))

    bits, data = 0.0, text.encode()
    for i, byte in enumerate(data):
        before = (bytes([language.PAD]) * order + data[:i])[-order:]
        depth, context = 0, 0
        while depth < order:
            longer = context | before[-depth - 1] << 8 * depth
            if (depth + 1, longer) not in known:
                break
            depth, context = depth + 1, longer
        bits -= math.log2(share(depth, context, byte))
    return bits


def test_code_lengths_equal_brute_force():
    train = [(lang, text_of(lang, s, 8)) for lang in SYLLABLES for s in range(2)]
    counts = counts_of(train, 2)
    trees = language.ContextTrees.built(sorted(SYLLABLES), counts, 2)
    texts = [text_of("aa", 99, 5), "zz éau", "q", text_of("cc", 98, 4)]
    got = trees.text_lengths([t.encode() for t in texts])
    want = [[brute_length(counts, lang, t, 2) for lang in sorted(SYLLABLES)] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


def test_probabilities_of_each_context_sum_to_one():
    counts = counts_of([(lang, text_of(lang, 1, 30)) for lang in SYLLABLES], 3)
    trees = language.ContextTrees.built(sorted(SYLLABLES), counts, 3)
    sums = np.exp2(-trees.costs.astype(float)).reshape(trees.size, 256, -1).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)


def test_long_texts_in_slices(monkeypatch):
    counts = counts_of([(lang, text_of(lang, 1, 30)) for lang in SYLLABLES], 3)
    trees = language.ContextTrees.built(sorted(SYLLABLES), counts, 3)
    texts = [text_of("aa", 5, 400).encode(), b"", b"x", text_of("cc", 5, 300).encode()]
    whole = trees.text_lengths(texts)
    monkeypatch.setattr(language, "CHUNK", 50)
    assert np.allclose(trees.text_lengths(texts), whole, rtol=1e-6)


def test_held_out_accuracy_and_edges(spark):
    rows = [(i, text_of(lang, i), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(900, None, "aa"), (901, "123 456", "aa"), (902, "", None), (903, text_of("bb", 903), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = {r["doc_id"]: r for r in language.predict(docs, ~held_out, order=3, max_contexts=400).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang_pred"] == lang and 0.5 < got[i]["score"] <= 1 for i, _, lang in rows[:180])
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"]
    assert got[900]["score"] == 0


def test_edge_rows(spark):
    docs = edge_docs(spark)
    got = language.predict(docs, F.lit(True), order=2)
    assert got.count() == docs.count()
    assert language.predict(docs, F.lit(False)).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.predict(no_docs(spark), F.lit(True)).count() == 0
