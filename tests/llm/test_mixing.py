import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from llm_rows import edge_docs, no_docs
from oracle_util import duck, same

from wardflow.llm import mixing, oracles

SF = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(sizes):
    """Round after round, with fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in sizes if s not in full)
        got = {s: Fraction(3 * sizes[s]) if s in full else Fraction(weight[s] * left, open_weight) for s in sizes}
        above = {s for s in sizes if got[s] > 3 * sizes[s]}
        if not above:
            return got
        full |= above


def check(rows, texts, block=16, shard=1 << 20):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(d), words(t)) for d, t, _ in texts)
    for d, t, s in texts:
        sizes[s] += words(t)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    want = expected_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(float(want[s]), rel=1e-12, abs=1e-9)
        # A block's half for the source and one for the last pass, and a block that a shard's end leaves over.
        assert abs(taken[s] - target[s]) <= block * (2 + math.ceil(sizes[s] / shard)), s


def made(seed, n_docs, sources):
    rnd = random.Random(seed)
    return [(i, " ".join("w" * rnd.randint(1, 9) for _ in range(rnd.choice([0, 3, 40, 400]))), rnd.choice(sources)) for i in range(n_docs)]


@pytest.mark.parametrize("seed,sources,shard", [(1, ["a", "b", "c", "d", None], 1 << 20), (2, ["x"] * 30 + ["ä", "Z", "", None], 900),
                                                (3, ["one"], 300)])
def test_targets_and_taken_words(spark, seed, sources, shard):
    texts = made(seed, 300, sources)
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(4)
    rows = mixing.mix(docs, shard_words=shard).collect()
    check(rows, texts, shard=shard)
    again = mixing.mix(docs.repartition(7), shard_words=shard).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_small_shards_equal_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ok, a, b = same(mixing.mix(docs, shard_words=700).drop("source"), duck(SF), oracles.mixing_sql(16, 700))
    assert ok, sorted(set(a[1]) ^ set(b[1]))[:3]


def test_seats_go_to_the_highest_quotients(spark):
    rnd = random.Random(5)
    groups = {g: {p: rnd.choice([0, 1, 7, 7, 100, 5000]) for p in range(rnd.randint(1, 40))} for g in range(12)}
    totals = {g: rnd.choice([0, 1, 5, 60, 1000]) for g in groups}
    rows = [(g, p, float(w), totals[g]) for g, own in groups.items() for p, w in own.items()]
    got = mixing.apportion(spark.createDataFrame(rows, "grp long, party long, weight double, total long"), "t").collect()
    got = {(r["grp"], r["party"]): r["seats"] for r in got}
    for g, own in groups.items():
        seats = dict.fromkeys(own, 0)
        for _ in range(totals[g] if any(own.values()) else 0):
            seats[max(own, key=lambda p: (own[p] / (2 * seats[p] + 1), -p))] += 1
        assert {p: got.get((g, p), 0) for p in own} == seats


def test_edge_rows(spark):
    docs = edge_docs(spark)
    texts = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    rows = mixing.mix(docs)
    assert rows.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    check(rows.collect(), texts)
    assert mixing.mix(no_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " \n", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r)[2:] for r in mixing.mix(blank).collect()) == [(0, 0, 0.0, 0)] * 2


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
