import collections
import random
import re

import numpy as np
from llm_rows import edge_docs, no_docs, prose
from pyspark.sql import functions as F

from wardflow.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if times[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_statistics(spark):
    odd = ["a b c a b c", "a a a a a", "x\ny\nx\n \n \n", "#*$ %&|<>\x0b\x0c\r z", "　   é", "a b", "a b c d a b c\x1fd"]
    rnd = random.Random(2)
    odd += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").union(
        edge_docs(spark).select("doc_id", "text").filter("doc_id > 1").selectExpr("doc_id + 1000", "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.text_statistics(docs).collect():
        assert tuple(r[c] for c in quality.STATS) == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_edge_rows(spark):
    docs = edge_docs(spark)
    out = quality.quality_verdicts(docs)
    assert out.count() == docs.count()
    for r in out.collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.quality_verdicts(no_docs(spark)).count() == 0
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted(
        (r["doc_id"] or 0) for r in out.filter("kept").collect())


def test_outliers_go_and_clean_documents_stay(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(400):
        junk = i % 20 == 0
        text = prose(i, rnd.randint(60, 400))
        if junk:
            text = " ".join(w + "%%%###" for w in text.split())
        rows.append((i, text, "en" if i % 2 else None, "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(docs).collect()}
    assert all(kept[i] == (i % 20 != 0) for i in kept)


def frame_of(spark, groups):
    rows = [(i, g, i % quality.SALTS, *map(float, v)) for g, x in groups.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, g string, salt int, " + ", ".join(f"{f} double" for f in quality.FEATURES))


FLOOR = np.diag(np.array(quality.FLOORS) ** 2)


def low(v, q):
    return np.sort(v)[max(0, int(np.ceil(q * len(v))) - 1)]


def in_numpy(x, start, steps=20):
    """Concentration steps from one start: mean, covariance, logarithm of its determinant."""
    if start == "median":
        m = np.array([low(c, .5) for c in x.T])
        c = np.diag([(1.4826 * low(np.abs(x[:, k] - m[k]), .5)) ** 2 for k in range(5)]) + FLOOR
    else:
        m, c = x.mean(axis=0), np.cov(x.T, bias=True) + FLOOR
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        near = x[d <= low(d, .75)]
        m, c = near.mean(axis=0), np.cov(near.T, bias=True) + FLOOR
    return m, c, np.linalg.slogdet(c)[1]


def one_start_fails():
    """Medians of the columns lie in no cluster of the rows: from there the steps settle on a wider set than from the mean, or
    the other way round (found by trying seeds)."""
    for seed in range(200):
        rng = np.random.default_rng(seed)
        x = np.concatenate([rng.normal(size=(150, 5)) * .3, rng.normal(size=(50, 5)) * .5 + rng.normal(size=5) * 6,
                            rng.normal(size=(60, 5)) * [4, .1, 4, .1, 4] + rng.normal(size=5) * 4])
        ends = [in_numpy(x, s)[2] for s in ("median", "mean")]
        if abs(ends[0] - ends[1]) > 0.1:
            return x, ends
    raise AssertionError("no such rows")


def test_the_lesser_determinant_of_two_starts_is_taken(spark):
    hard, ends = one_start_fails()
    rng = np.random.default_rng(6)
    plain = rng.normal(size=(300, 5)) * [1, 2, .3, .5, .4]
    plain[:40] += 6
    got = {r["g"]: r for r in quality.estimates(frame_of(spark, {"hard": hard, "plain": plain}), 0.75, 20).collect()}
    assert got["hard"]["det"] < max(ends) - 0.05 and abs(got["hard"]["det"] - min(ends)) < 2e-3
    for g, x in (("hard", hard), ("plain", plain)):
        m, c, det = min((in_numpy(x, s) for s in ("median", "mean")), key=lambda e: e[2])
        assert got[g]["n"] == len(x) and abs(got[g]["det"] - det) < 2e-3  # settled to a thousandth
        assert np.allclose([got[g][f"m{i}"] for i in range(5)], m, atol=0.02)
        assert np.allclose([got[g][f"c{i}{j}"] for i, j in quality._pairs()], [c[i, j] for i, j in quality._pairs()], atol=0.05)


def test_estimates_are_shrunk_towards_language_and_all(spark):
    rng = np.random.default_rng(1)
    groups = {"big": rng.normal(size=(400, 5)), "few": rng.normal(size=(3, 5)) + 1, "alone": rng.normal(size=(1, 5)) + 2}
    frame = frame_of(spark, groups)
    rows = frame.withColumn("g_language", F.when(F.col("g") == "alone", "y").otherwise("x"))
    got = {r["g"]: np.array([r[f"m{i}"] for i in range(5)]) for r in quality.group_estimates(rows, 0.75, 20, 100).collect()}
    best = lambda x: min((in_numpy(x, s) for s in ("median", "mean")), key=lambda e: e[2])[0]
    mixed = lambda x, up: (len(x) * best(x) + 100 * up) / (len(x) + 100)
    everything = best(np.concatenate(list(groups.values())))
    x = mixed(np.concatenate([groups["big"], groups["few"]]), everything)
    y = mixed(groups["alone"], everything)
    assert np.allclose(got["big"], mixed(groups["big"], x), atol=0.02)
    assert np.allclose(got["few"], mixed(groups["few"], x), atol=0.02)
    assert np.allclose(got["alone"], mixed(groups["alone"], y), atol=0.02)


def test_every_document_has_a_verdict(spark):
    rows = [(i, prose(i, 80), "en", "s") for i in range(60)]
    rows += [(100, prose(100, 80), "xx", "only"), (101, " ".join(w + "%%%###&&&" for w in prose(101, 80).split()), "yy", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.quality_verdicts(docs).collect()}
    assert all(r["distance"] is not None for r in got.values())
    assert got[100]["kept"] and not got[101]["kept"]


def verdicts(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    return {r["doc_id"]: r for r in quality.quality_verdicts(docs).collect()}


def lines_of(seed, n, words=8):
    return [prose(seed * 1000 + k, words) for k in range(n)]


def test_repeated_lines_and_repeated_words_reject_each_alone(spark):
    """In a group without repeats; two words in a line are no window that comes twice."""
    clean = ["\n".join(lines_of(i, 10 + i % 40)) for i in range(200)]
    same = "\n".join("ab cd" if k % 2 else f"a{k} {prose(5000 + k, 8)} z{k}" for k in range(40))  # half of the lines, no window twice
    odd = prose(1, 60)
    words = "\n".join(lines_of(301, 30) + [odd + " x " + prose(2, 55) + " " + odd])  # no line twice
    both = lines_of(302, 12)
    got = verdicts(spark, clean + [same, words, "\n".join(both + both[:5])])
    assert all(got[i]["kept"] for i in range(200))
    a, b = got[200], got[201]
    assert not a["base_failed"] and a["n_dup_lines"] > 10 and a["n_repeat_words"] == 0 and not a["kept"]
    assert not b["base_failed"] and b["n_dup_lines"] == 0 and b["n_repeat_words"] == 120 and not b["kept"]


def test_one_repeated_line_stays_at_any_length(spark):
    clean = ["\n".join(lines_of(i, int(10 * 40 ** (i / 199)))) for i in range(200)]
    once = []
    for k, n in enumerate((10, 20, 50, 400)):
        own = lines_of(400 + k, n)
        once.append("\n".join([*own, own[n // 2]]))
    got = verdicts(spark, clean + once)
    for r in (got[200 + k] for k in range(4)):
        assert r["n_dup_lines"] == 1 and not r["base_failed"] and r["kept"], r
