"""Imputation, one-hot, exact balanced split, folds, profile, shares."""

import hashlib
import random

from wardflow.operators import prep


def _frame(spark, n=3000, p1=0.23, seed=5):
    rnd = random.Random(seed)
    data = [(i * 7 + 3, 1 if rnd.random() < p1 else 0, rnd.choice(["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(data, "hadm_id long, y int, cat string"), data


def test_class_rank_equals_row_number(spark):
    df, data = _frame(spark)
    got = {r["hadm_id"]: r["_rank"] for r in prep.class_rank(df, "y", "hadm_id", bucket_digits=2).collect()}
    for k in (0, 1):
        ids = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i, y, _ in data if y == k)
        for pos, (_, i) in enumerate(ids, start=1):
            assert got[i] == pos


def test_balanced_split_properties(spark):
    df, data = _frame(spark)
    s = prep.balanced_split(df, "y", "hadm_id").cache()
    assert s.columns == ["hadm_id", "y", "cat", "split"]  # nothing that tells the split beside it
    ranked = {r["hadm_id"]: r["_rank"] for r in prep.class_rank(df, "y", "hadm_id").collect()}
    half = min(sum(y for _, y, _ in data), sum(1 - y for _, y, _ in data)) // 2
    assert {r["hadm_id"] for r in s.where("split = 'train'").collect()} == {i for i, k in ranked.items() if k <= half}
    n0 = sum(1 for _, y, _ in data if y == 0)
    n1 = len(data) - n0
    train = s.where("split = 'train'")
    counts = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    assert counts == {0: min(n0, n1) // 2, 1: min(n0, n1) // 2}
    assert s.count() == len(data) and s.select("hadm_id").distinct().count() == len(data)


def test_folds_balanced(spark):
    df, _ = _frame(spark, n=1001)
    f = prep.stratified_folds(df, "y", "hadm_id", k=3)
    sizes = {}
    for r in f.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    for v in sizes.values():
        assert len(v) == 3 and max(v) - min(v) <= 1


def test_one_hot_and_impute(spark):
    df = spark.createDataFrame([(1, "b", None, None), (2, None, 3, "x"), (3, "a", 1, None)],
                               "hadm_id long, race string, n long, s string")
    oh = prep.one_hot(df, "race")
    assert oh.columns == ["hadm_id", "n", "s", "race_a", "race_b"]
    assert {r["hadm_id"]: (r["race_a"], r["race_b"]) for r in oh.collect()} == {1: (0, 1), 2: (0, 0), 3: (1, 0)}
    imp = {r["hadm_id"]: (r["race"], r["n"], r["s"]) for r in prep.impute(df).collect()}
    assert imp == {1: ("b", 0, "UNKNOWN"), 2: ("UNKNOWN", 3, "x"), 3: ("a", 1, "UNKNOWN")}
    assert prep.categories_of(df, ["race", "s"]) == {"race": ["a", "b"], "s": ["x"]}


def test_profile_and_shares(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id long, v string")
    p = {r["column_name"]: (r["position"], r["data_type"], r["non_null_count"], r["row_count"])
         for r in prep.profile(df).collect()}
    assert p == {"id": (0, "bigint", 3, 3), "v": (1, "string", 2, 3)}
    sh = {r["y"]: (r["n"], r["share"]) for r in
          prep.class_shares(spark.createDataFrame([(0,), (0,), (1,), (0,)], "y int"), "y").collect()}
    assert sh == {0: (3, 0.75), 1: (1, 0.25)}


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id long, y int")
    assert {r["split"] for r in prep.balanced_split(df, "y", "id").collect()} == {"test"}
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 0), (5, None), (6, 7)], "id long, y int")
    got = prep.balanced_split(df, "y", "id", bucket_digits=1).collect()
    assert sorted((r["y"], r["split"]) for r in got) == [(0, "test"), (0, "train"), (1, "test"), (1, "train")]


def test_one_hot_vector_equals_the_wide_form(spark):
    rows = [(i, None if i % 7 == 0 else f"v{i % 1500:04d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, c string")
    values = sorted({v for _, v in rows if v})
    assert len(values) > 1000
    got = {r["id"]: r["c_vec"] for r in prep.one_hot_vector(df, "c").collect()}
    for i, v in rows:
        assert got[i].size == len(values)
        assert got[i].indices.tolist() == ([values.index(v)] if v else [])


def test_groups_stay_together(spark):
    df = spark.createDataFrame([(i, i % 50 if i % 3 else None) for i in range(600)], "id long, g long")
    rows = prep.group_split(df, "g").collect()
    sides = {}
    for r in rows:
        sides.setdefault(r["g"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values()) and sides[None] == {"train"}
    assert 3 <= sum(s == {"test"} for s in sides.values()) <= 20
