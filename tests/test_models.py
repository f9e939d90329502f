"""Models and rows-only queries: structure, not skill (the test label carries
almost no signal), and what can be worked out exactly."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from wardflow.operators import models
from wardflow.plans import modelling as M
from wardflow.profiles import clinical as P
from wardflow.sources.synthetic import tables

TINY = {"LogisticRegression": {"C": [1]}, "RandomForest": {"numTrees": [5], "maxDepth": [3]},
        "GradientBoosting": {"maxIter": [2], "stepSize": [0.1]}}


def test_the_grids_are_whole():
    assert models.GRIDS == {"LogisticRegression": {"C": [0.1, 1, 10]}, "RandomForest": {"numTrees": [50, 100], "maxDepth": [10, 20]},
                            "GradientBoosting": {"maxIter": [50, 100], "stepSize": [0.01, 0.1]}}
    for run in (M.grid_search_table, M.model_table):
        assert run.__defaults__ == (("LogisticRegression", "RandomForest", "GradientBoosting"), models.GRIDS)
    assert models.grid_points({"a": [1, 2], "b": [3, 4]}) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]


def test_features_are_pinned(spark):
    split = M.split_frame(tables(spark, SF_SMALL))
    features = M.feature_columns(split)
    assert features == [*P.NUMERIC_FEATURES, *[c for c in split.columns if c.startswith(("race_", "top_drg_type_"))]]
    assert len(P.NUMERIC_FEATURES) == 19 and len(features) == 28
    assert split.columns == ["hadm_id", *[c for c in split.columns if c in (*features, P.LABEL)], "split"]
    # A column that some step adds is no feature.
    assert M.feature_columns(split.withColumn("_rank", F.lit(1)).withColumn("fold", F.lit(0))) == features


def test_vectors_hold_the_features_of_the_wide_frame(spark):
    t = tables(spark, SF_SMALL)
    v = M.Vectors(t)
    wide = M.split_frame(t)
    names = M.feature_columns(wide)
    slots = {r["slot"]: r["feature"] for r in v.slots().collect()}
    assert [slots[i] for i in range(len(slots))] == names
    want = {r["hadm_id"]: (r["split"], [float(r[c]) for c in names]) for r in wide.collect()}
    rows = v.table.withColumn("x", vector_to_array("features")).collect()
    assert {r["hadm_id"]: (r["split"], r["x"]) for r in rows} == want
    assert all((r["fold"] is None) == (r["split"] == "test") for r in rows)


def test_lr_scores_the_hold_out(spark):
    t = tables(spark, SF_SMALL)
    split = M.split_frame(t)
    n_test = split.where("split = 'test'").count()
    pred = E.queries()["lr_fit"](spark, SF_SMALL)
    assert pred.columns == ["hadm_id", "readmission_flag", "prediction", "probability_1"]
    assert pred.count() == n_test
    bad = pred.where((F.col("probability_1") < 0) | (F.col("probability_1") > 1) | ~F.col("prediction").isin(0, 1))
    assert bad.count() == 0


def test_trees_score_the_hold_out(spark):
    t = tables(spark, SF_SMALL)
    for name, params in (("RandomForest", {"numTrees": 3, "maxDepth": 3}), ("GradientBoosting", {"maxIter": 2})):
        pred = M.fit_and_score(t, name, **params)
        assert pred.where("probability_1 between 0 and 1 and prediction in (0, 1)").count() == pred.count() > 0


def test_model_table_and_grid(spark):
    t = tables(spark, SF_SMALL)
    rows = {r["model"]: r for r in M.model_table(t, grids=TINY).collect()}
    assert set(rows) == set(TINY)
    for r in rows.values():
        assert 0.0 <= r["accuracy"] <= 1.0 and r["support"] > 0
    grid = M.grid_search_table(t, grids={**TINY, "LogisticRegression": {"C": [0.1, 10]}}).collect()
    assert [(r["model"], r["params"]) for r in grid] == [
        ("LogisticRegression", "C=0.1"), ("LogisticRegression", "C=10"), ("RandomForest", "numTrees=5, maxDepth=3"),
        ("GradientBoosting", "maxIter=2, stepSize=0.1")]


def _made(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=n) > 0).astype(float)
    rows = [(i, Vectors.dense(*map(float, x[i])), float(y[i]), i % 3) for i in range(n)]
    return models.sized(spark.createDataFrame(rows, ["id", "features", "y", "fold"]), "id").cache()


def test_the_winner_is_refit_with_its_own_penalty(spark):
    data = _made(spark, 90)
    model, _ = models.grid_search(data, "y", "fold", "LogisticRegression", {"C": [0.01]})
    assert abs(model.getRegParam() - 1 / (0.01 * 90)) < 1e-12


def test_stages_of_one_fit_are_the_shorter_fits(spark):
    data = _made(spark)
    grid = {"maxIter": [3, 6], "stepSize": [0.1, 0.5]}
    _, staged = models.grid_search(data, "y", "fold", "GradientBoosting", grid, refit=False)
    assert models.fits_of("GradientBoosting", models.grid_points(grid)) == [[0, 2], [1, 3]]
    for point, (_, _, accuracy) in zip(models.grid_points(grid), staged):
        alone = []
        for k in range(3):
            model = models.estimator("GradientBoosting", "y", 160, **point).fit(data.where(f"fold <> {k}"))
            scored = model.transform(data.where(f"fold = {k}"))
            alone.append(scored.where("prediction = y").count() / scored.count())
            margins = models.staged_margins(model, data.where(f"fold = {k}"), [point["maxIter"]])
            raw = model.transform(margins).select(f"margin_{point['maxIter']}", vector_to_array("rawPrediction")[1]).collect()
            assert all(abs(a - b) < 1e-12 for a, b in raw)
        assert abs(accuracy - sum(alone) / 3) < 1e-12, point


def test_trees_of_a_forest_serve_the_larger_one(spark):
    data = _made(spark)
    grid = {"numTrees": [2, 5], "maxDepth": [3]}
    assert models.fits_of("RandomForest", models.grid_points(grid)) == [[0, 1]]
    _, rows = models.grid_search(data, "y", "fold", "RandomForest", grid, refit=False)
    train, valid = data.where("fold <> 0"), data.where("fold = 0")
    both = [models.random_forest("y", n, 3, models.SEED + i).fit(train) for i, n in enumerate((2, 3))]
    votes = {r["id"]: (r["votes_2"], r["votes_5"]) for r in models.staged_votes(train, valid, "y", [2, 5], 3).collect()}
    for r in valid.collect():
        first, more = (m.predictRaw(r["features"]).toArray() for m in both)
        assert np.allclose(votes[r["id"]], (first, first + more), atol=1e-12) and abs(sum(votes[r["id"]][1]) - 5) < 1e-9
    alone = [models.random_forest("y", 2, 3).fit(data.where(f"fold <> {k}")).transform(data.where(f"fold = {k}")) for k in range(3)]
    assert abs(rows[0][2] - sum(s.where("prediction = y").count() / s.count() for s in alone) / 3) < 1e-12


def test_partitions_of_a_fit_dont_grow_with_small_ones():
    assert [models.partitions_for(n) for n in (0, 1, 20_001, 480_000, 7_200_000, 12_000_001)] == [1, 1, 2, 24, 24, 25]
    assert models.random_forest("y", 5, 20).getCacheNodeIds() and not models.random_forest("y", 5, 10).getCacheNodeIds()


def test_fits_are_repeatable(spark):
    data = _made(spark)
    shuffled = models.sized(data.repartition(7), "id")
    a, b = (models.random_forest("y", 5, 4).fit(d).toDebugString.split("\n", 1)[1] for d in (data, shuffled))
    assert a == b


def test_a_deep_forest_is_grown_in_parts(spark, monkeypatch):
    """However many trees there are, the driver never holds more than so many nodes (or one tree)."""
    data = _made(spark)
    grown, make = [], models.random_forest

    def recorded(label, num_trees=100, max_depth=10, seed=models.SEED):
        forest = make(label, num_trees, max_depth, seed)
        fit = forest.fit
        forest.fit = lambda df: grown.append((num_trees, seed, fit(df))) or grown[-1][2]
        return forest

    monkeypatch.setattr(models, "random_forest", recorded)
    monkeypatch.setattr(models, "NODES_AT_ONCE", 150)
    train, valid = data.where("fold <> 0"), data.where("fold = 0")
    out = models.staged_votes(train, valid, "y", [3, 6], 6)
    assert out.columns == [*valid.columns, "votes_3", "votes_6"]
    assert len(grown) > 2 and sum(n for n, _, _ in grown) == 6
    assert all(n == 1 or m.totalNumNodes <= 150 for n, _, m in grown), [(n, m.totalNumNodes) for n, _, m in grown]
    assert len({seed for _, seed, _ in grown}) == len(grown)
    votes, trees = {r["id"]: r for r in out.collect()}, np.cumsum([n for n, _, _ in grown])
    assert 3 in trees and trees[-1] == 6
    for r in valid.collect():
        want = np.cumsum([m.predictRaw(r["features"]).toArray() for _, _, m in grown], axis=0)
        assert np.allclose(votes[r["id"]]["votes_6"], want[-1]) and np.allclose(votes[r["id"]]["votes_3"], want[list(trees).index(3)])
    assert len(votes) == valid.count()
    # A fit of such a forest is grown when it scores, with the columns of a fitted one.
    model = models.fitted("RandomForest", train, "y", train.count(), numTrees=3, maxDepth=6)
    assert isinstance(model, models.GrownForest)
    for r in models.score(model, valid, "y", keep=("id",)).collect():
        assert 0 <= r["probability_1"] <= 1 and r["prediction"] == int(r["probability_1"] > 0.5)


def test_scores_of_a_forest_in_one_part_are_the_fitted_ones(spark):
    data = _made(spark)
    train, valid = data.where("fold <> 0"), data.where("fold = 0")
    model = models.fitted("RandomForest", train, "y", 160, numTrees=5, maxDepth=4)
    assert not isinstance(model, models.GrownForest)
    want = {r["id"]: r for r in models.score(model, valid, "y", keep=("id",)).collect()}
    for r in models.score(models.GrownForest(train, "y", 5, 4), valid, "y", keep=("id",)).collect():
        assert r["prediction"] == want[r["id"]]["prediction"] and abs(r["probability_1"] - want[r["id"]]["probability_1"]) < 1e-12


def test_fits_under_way_fit_the_driver():
    points = models.grid_points({"numTrees": [50, 100], "maxDepth": [10, 20]})
    gb = 1 << 30
    assert [models.fits_at_once("RandomForest", points, 100_000, h) for h in (gb // 2, gb, 4 * gb, 16 * gb)] == [1, 1, 3, 14]
    assert models.fits_at_once("RandomForest", points, 100, gb) > 8 and models.fits_at_once("LogisticRegression", [{"C": 1}], 10**9, gb) > 8


def test_scores_are_decided_exactly(spark):
    """3, 9, 65 and 8 give a score of exactly 0, which doubles put above it."""
    df = spark.createDataFrame([(3, 9, 65, 8), (3, 9, 64, 8), (3, 9, 66, 8)], "a int, b int, c int, d long")
    out = models.linear_scores(df, {"a": 0.8, "b": -0.25, "c": -0.01, "d": 0.125}, -0.5).collect()
    assert [r["prediction"] for r in out] == [0, 1, 0] and out[0]["probability_1"] == 0.5
    half = models.linear_scores(df.selectExpr("a / 2 as a"), {"a": 1.0}, -1.0, threshold=0.6).first()
    assert half["prediction"] == 1 and abs(half["probability_1"] - 1 / (1 + np.exp(-0.5))) < 1e-12


def test_embeddings_keep_rows_without_codes(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (3, "b c")], "id long, s string")
    got = {r["id"]: r["embedding"] for r in models.code_embeddings(df, ["id"], "s", vector_size=4, partitions=1).collect()}
    assert got[2] == [0.0] * 4 and any(got[1]) and any(got[3])


def test_embeddings_pca_importance(spark):
    q = E.queries()
    for name in ("code_embeddings", "procedure_embeddings"):
        assert len(q[name](spark, SF_SMALL).first()["embedding"]) == 16
    pca = [r["explained_variance"] for r in q["pca_variance"](spark, SF_SMALL).orderBy("component").collect()]
    assert len(pca) == 5 and pca == sorted(pca, reverse=True) and sum(pca) <= 1.0 + 1e-9
    imp = M.feature_importance(tables(spark, SF_SMALL), num_trees=5, max_depth=3).collect()
    assert len(imp) == 28 and abs(sum(r["importance"] for r in imp) - 1.0) < 1e-6
    assert any(r["coefficient"] for r in imp)
