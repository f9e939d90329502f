import random

import numpy as np
import pytest
from llm_rows import WORDS, edge_docs, no_docs, prose

from wardflow.llm import probminhash as M


def brute_similarity(x, y):
    total = 0.0
    for i in x:
        if i in y:
            total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y})
    return total


def arrays(d):
    keys = sorted(d)
    return np.array(keys, dtype=np.uint64), np.array([float(d[k]) for k in keys])


def test_probability_jaccard_equals_its_definition():
    rnd = random.Random(1)
    for _ in range(200):
        x = {rnd.randint(0, 12): rnd.randint(1, 4) for _ in range(rnd.randint(1, 9))}
        y = {rnd.randint(0, 12): rnd.randint(1, 4) for _ in range(rnd.randint(1, 9))}
        assert abs(M.probability_jaccard(*arrays(x), *arrays(y)) - brute_similarity(x, y)) < 1e-9


def test_unit_weights_give_jaccard():
    x, y = set(range(20)), set(range(5, 28))
    one = lambda s: arrays(dict.fromkeys(s, 1))
    assert abs(M.probability_jaccard(*one(x), *one(y)) - len(x & y) / len(x | y)) < 1e-12


def test_components_agree_as_often_as_the_similarity():
    rnd = random.Random(2)
    x = {i: rnd.randint(1, 5) for i in range(60)}
    y = {i: (x[i] if i in x and rnd.random() < .8 else rnd.randint(1, 5)) for i in range(8, 66)}
    size, agree, runs = 64, 0, 60
    for run in range(runs):
        shift = np.uint64(run * 1_000_003)
        (a, wa), (b, wb) = arrays(x), arrays(y)
        agree += (M.signature(M.mixed(a + shift), wa, size) == M.signature(M.mixed(b + shift), wb, size)).sum()
    s = brute_similarity(x, y)
    assert abs(agree / (size * runs) - s) < 4 * (s * (1 - s) / (size * runs)) ** .5


def test_early_termination_changes_nothing():
    rng = np.random.default_rng(3)
    elements, weights, size = rng.integers(1, 1 << 60, 30).astype(np.uint64), rng.integers(1, 4, 30).astype(float), 16
    got = M.signature(elements, weights, size)
    # All arrivals up to a late time, without stopping.
    first, holder = np.full(size, np.inf), np.zeros(size, dtype=np.uint64)
    for e, w in zip(elements, weights):
        t = 0.0
        for k in range(400):
            bits = M.mixed(np.array([e]) + M.mixed(np.array([k], dtype=np.uint64) * np.uint64(M._ODD[1])))
            t += -np.log((float(bits[0] >> np.uint64(11)) + 0.5) / 2.0 ** 53) / w
            slot = int(M.mixed(bits ^ np.uint64(M._ODD[2]))[0] % np.uint64(size))
            if t < first[slot]:
                first[slot], holder[slot] = t, e
    assert (got == holder).all()


def classes(texts, threshold=0.8, width=5):
    """Brute force: all pairs, then components."""
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else None)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [512, 16])
def test_classes_equal_brute_force(spark, block):
    rnd = random.Random(4)
    texts = [prose(i, rnd.randint(1, 60)) for i in range(40)]
    base = prose(1000, 100).split()
    for k in range(70):  # a large group of copies, near and less near
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 6])):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        texts.append(" ".join(words))
    passage = prose(2000, 60)
    texts += [prose(3000 + i, 25) + " " + passage for i in range(30)] + texts[:5] + ["", None, " \n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(docs, block=block).collect()}
    assert [got[i] for i in range(len(texts))] == classes(texts)


def test_count_weights(spark):
    line = prose(1, 40)
    rows = [(1, line + " " + line + " " + prose(5, 30)), (2, line + " " + line + " " + prose(5, 30) + " x"), (3, prose(6, 60))]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), weighting="count")
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == {1: 1, 2: 1, 3: 3}


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = M.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert got[1] == got[2] == got[3] == {1} and got[None] == {None}
    assert all(got[i] == {i} for i in range(4, 12))
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["class_id"]) for r in rows)
    assert M.near_duplicates(no_docs(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    from wardflow.llm.components import connected_components
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(200)] + [(500, 501 + i) for i in range(50)] + [(900, 900), (901, 902), (902, 901)]
    rnd.shuffle(links)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{500 + i: 500 for i in range(51)}, 901: 901, 902: 901}
