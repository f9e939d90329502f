import numpy as np
import pytest

from wardflow.llm import projections

SCHEMA = "vec_id long, embedding array<float>, label int, node long, v string, block int, rank long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", 2, 3) for r in rows], SCHEMA).repartition(3)


def brute(rows, threshold=0.98):
    usable = [(i, np.array(v, dtype=np.float32).astype(float), lab) for i, v, lab in rows
              if i is not None and lab is not None and v is not None and len(v) and all(x is not None for x in v)
              and np.isfinite(v).all() and np.any(v)]
    links, root = {}, {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for k, (i, x, a) in enumerate(usable):
        for j, y, b in usable[:k]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i] = links.get(i, 0) + 1
                links[j] = links.get(j, 0) + 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return links, find


def near(rng, x, angle):
    y = rng.normal(size=x.shape)
    y -= (y @ x) / (x @ x) * x
    return x / np.linalg.norm(x) + np.tan(angle) * y / np.linalg.norm(y)


@pytest.mark.parametrize("block", [32, 1024])
def test_links_and_components_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = []
    for label in range(2):
        for _ in range(60):
            x = rng.normal(size=16)
            for _ in range(rng.integers(1, 4)):
                rows.append((len(rows), near(rng, x, rng.uniform(0, .3)).tolist(), label))
    x = rng.normal(size=16)
    for _ in range(150):  # a large group, wider than the window
        rows.append((len(rows), near(rng, x, rng.uniform(0, .2)).tolist(), 0))
    rows += [(len(rows) + k, rows[5][1], 0) for k in range(20)]  # equal vectors
    links, find = brute(rows)
    got = {r["vec_id"]: r for r in projections.embedding_duplicates(frame(spark, rows), window=16, block=block).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: links.get(i, 0) for i in got}
    assert {i: r["component_id"] for i, r in got.items()} == {i: find(i) for i in got}
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_recall_at_the_threshold(spark):
    """Pairs at exactly the least similarity, among others of their label."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(400):
        x = rng.normal(size=64)
        rows += [(2 * k, x.tolist(), 0), (2 * k + 1, near(rng, x, np.arccos(.981)).tolist(), 0)]
    got = projections.embedding_duplicates(frame(spark, rows), window=32).filter("n_links = 1").count()
    assert got >= 0.97 * len(rows)


def common_direction(n, mean_cosine):
    """Pairs at cosine 0.981 in one label whose vectors share a direction."""
    rng, rows = np.random.default_rng(4), []
    shared = np.eye(64)[0]
    for k in range(n // 2):
        x = rng.normal(size=64)
        x = np.sqrt(mean_cosine) * shared + np.sqrt(1 - mean_cosine) * x / np.linalg.norm(x)
        rows += [(2 * k, x.tolist(), 0), (2 * k + 1, near(rng, x, np.arccos(.981)).tolist(), 0)]
    return rows


@pytest.mark.parametrize("n, mean_cosine, window, all_pairs", [(3000, .9, 8, False), (500, .96, 4, True)])
def test_recall_where_a_label_shares_a_direction(spark, n, mean_cosine, window, all_pairs):
    rows = common_direction(n, mean_cosine)
    x = projections.unit_rows([np.float32(v) for _, v, _ in rows])
    need = projections.passes_needed(x[:1024], n, .98, window, 60, 10, .995)
    assert need > 10 and (2 * need * window >= n) == all_pairs
    want = (x @ x.T >= .98).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in projections.embedding_duplicates(frame(spark, rows), window=window).collect()}
    same = np.mean([got[i] == want[i] for i in range(n)])
    assert same == 1 if all_pairs else same >= 0.99


def test_passes_follow_size_and_closeness():
    x = {c: projections.unit_rows([v for _, v, _ in common_direction(1600, c)[::2]]) for c in (0, .8, .9)}
    need = lambda c, n: projections.passes_needed(x[c], n, .98, 64, 60, 10, .995)
    assert need(.9, 60) == need(0, 2000) == 10 < need(.8, 50_000) < need(.8, 200_000) < need(.9, 200_000)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1),
            (11, [1.0, -0.0], 2), (12, [1.0, 0.0], 2), (12, [1.0, 0.0], 2), (13, [1e-30, 0.0], 1), (14, [3e38, 0.0], 1)]
    out = projections.embedding_duplicates(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
    assert got[1] == got[2] == got[13] == got[14] == (3, 1)
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10)) and got[None] == (0, None)
    assert got[11] == got[12] == (2, 11)
    assert projections.embedding_duplicates(frame(spark, [])).count() == 0


def dense_spot(n, m, cosine):
    """A label of vectors in all directions, and pairs at cosine 0.981 in one spot that a small sample doesn't know."""
    rng, rows = np.random.default_rng(7), []
    for k in range(n):
        rows.append((k, rng.normal(size=64).tolist(), 0))
    spot = rng.normal(size=64)
    spot /= np.linalg.norm(spot)
    for k in range(m // 2):
        x = rng.normal(size=64)
        x = np.sqrt(cosine) * spot + np.sqrt(1 - cosine) * x / np.linalg.norm(x)
        rows += [(n + 2 * k, x.tolist(), 0), (n + 2 * k + 1, near(rng, x, np.arccos(.981)).tolist(), 0)]
    return rows


def test_a_dense_spot_that_the_sample_misses(spark):
    rows = dense_spot(2400, 120, .93)
    links, find = brute(rows[2400:])  # in the spot; the others have none
    got = {r["vec_id"]: r for r in projections.embedding_duplicates(frame(spark, rows), window=2, sample=6).collect()}
    right = [got[i]["n_links"] == links.get(i, 0) and got[i]["component_id"] == find(i) for i in range(2400, 2520)]
    assert np.mean(right) >= 0.995 and sum(got[i]["n_links"] for i in range(2400)) == 0


def test_shared_bits():
    a = np.array([0, 5, (1 << 60) - 1, 1 << 59, (1 << 59) - 1, 1 << 30])
    b = np.array([0, 4, (1 << 60) - 2, 0, 1 << 59, (1 << 31) - 1])
    assert projections.shared_bits(a, b, 60).tolist() == [60, 59, 59, 0, 0, 30]
