"""Per-stay aggregates: NULL handling, ordering, ties, top record."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wardflow.operators import aggregates as agg

K = ["subject_id", "hadm_id"]
T = dt.datetime


def test_distinct_ignores_version_and_nulls(spark):
    df = spark.createDataFrame([(1, 1, "410", 9), (1, 1, "410", 10), (1, 1, None, 9), (1, 2, None, 9)],
                               "subject_id long, hadm_id long, icd_code string, icd_version int")
    got = {r["hadm_id"]: r["n"] for r in agg.distinct_by_key(df, K, "icd_code", "n").collect()}
    assert got == {1: 1, 2: 0}


def test_sequence_order_nulls_and_ties(spark):
    df = spark.createDataFrame([
        (1, 1, 2, "b"), (1, 1, 2, "a"), (1, 1, 1, "z"), (1, 1, None, "n"), (1, 1, 3, None),
        (1, 2, 1, None),
    ], "subject_id long, hadm_id long, seq_num int, icd_code string")
    got = {r["hadm_id"]: r["s"] for r in agg.sequence_by_key(df, K, "icd_code", "seq_num", "s").collect()}
    # NULL order first (ASC), ties by token, NULL tokens skipped, all-NULL -> NULL (T13-T15)
    assert got == {1: "n z a b", 2: None}


def test_sequence_two_step_equals_one_step(spark):
    rnd = random.Random(3)
    data = [(1, rnd.randint(1, 3), rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, "x", "y", "w", "v1"]))
            for _ in range(400)]
    df = spark.createDataFrame(data, "subject_id long, hadm_id long, o int, t string")
    two = {r["hadm_id"]: r["s"] for r in agg.sequence_by_key(df, K, "t", "o", "s").collect()}
    one = {r["hadm_id"]: r["s"] for r in df.groupBy(*K).agg(
        F.expr("listagg(t, ' ') WITHIN GROUP (ORDER BY o ASC NULLS FIRST, t)").alias("s")).collect()}
    assert two == one


def test_top_record_desc_nulls_last(spark):
    df = spark.createDataFrame([
        (1, 1, "A", "100", None, 4), (1, 1, "B", "200", 2, None), (1, 1, "C", "050", 2, 1),
        (1, 2, "A", "1", None, None),
    ], "subject_id long, hadm_id long, drg_type string, drg_code string, drg_severity int, drg_mortality int")
    top = agg.top_record(df, K, ["drg_code", "drg_type", "drg_severity", "drg_mortality"],
                         ["drg_severity", "drg_mortality"], "t")
    got = {r["hadm_id"]: tuple(r["t"]) for r in top.collect()}
    # severity 2 beats NULL; within severity 2, mortality 1 beats NULL; all-NULL keys still give a row (T16)
    assert got == {1: ("050", "C", 2, 1), 2: ("1", "A", None, None)}


def test_duration_totals_overlap_same_day_and_reversed(spark):
    df = spark.createDataFrame([
        (1, 1, "d1", T(2100, 1, 1, 10), T(2100, 1, 3, 1)),    # 2 calendar days
        (1, 1, "d1", T(2100, 1, 2, 0), T(2100, 1, 4, 0)),     # overlaps: adds 2 more (T17)
        (1, 1, "d2", T(2100, 1, 5, 8), T(2100, 1, 5, 9)),     # same day: 0
        (1, 1, "d3", T(2100, 1, 5, 8), T(2100, 1, 4, 9)),     # stop before start: dropped
        (1, 1, "d4", T(2100, 1, 5, 8), None),                 # no stop: dropped
    ], "subject_id long, hadm_id long, drug string, starttime timestamp_ntz, stoptime timestamp_ntz")
    r = agg.duration_totals(df, K, "starttime", "stoptime", distinct_col="drug", distinct_name="u").collect()[0]
    assert (r["num_prescribed_days"], r["num_prescription_records"], r["u"]) == (4, 3, 2)


def test_count_filters_and_null_stay(spark):
    df = spark.createDataFrame([(1, 1, 10, "abnormal"), (2, 1, 11, "abnormal"), (3, None, 12, "abnormal"),
                                (4, 1, 13, None)], "labevent_id long, hadm_id long, x long, flag string") \
        .withColumn("subject_id", F.lit(1).cast("long"))
    got = {r["hadm_id"]: r["n"] for r in
           agg.count_by_key(df, K, "labevent_id", "n", where=F.col("flag") == "abnormal").collect()}
    assert got == {1: 2, None: 1}


def test_sequence_profile_equals_separate_aggregates(spark):
    """The fused one-pass aggregate equals sequence + count + distinct
    + top record computed separately (NULL tokens, NULL order values, NULL
    severities, repeated tokens)."""
    rnd = random.Random(11)
    data = [(rnd.randint(1, 2), rnd.randint(1, 4), rnd.choice([None, 1, 2, 3]),
             rnd.choice([None, "x", "y", "w", "v1"]), rnd.choice([None, 1, 2, 4, 8]),
             rnd.choice([None, 1, 2]), rnd.choice([None, 1, 3]))
            for _ in range(500)]
    df = spark.createDataFrame(data, "subject_id long, hadm_id long, o int, t string, m long, sev int, mort int")
    payload, order = ["t", "sev", "mort"], ["sev", "mort"]
    fused = agg.sequence_profile(df, K, "t", "o", "s", count_name="n", distinct_name="d",
                                 top=(payload, order, "top"))
    got = {(r["subject_id"], r["hadm_id"]): (r["s"], r["n"], r["d"], tuple(r["top"]))
           for r in fused.collect()}
    sep = df.groupBy(*K).agg(
        F.expr("listagg(t, ' ') WITHIN GROUP (ORDER BY o ASC NULLS FIRST, t)").alias("s"),
        F.count("t").alias("n"), F.countDistinct("t").alias("d"))
    top = agg.top_record(df, K, payload, order, "top")
    want = {(r["subject_id"], r["hadm_id"]): (r["s"], r["n"], r["d"], tuple(r["top"]))
            for r in sep.join(top, K).collect()}
    assert got == want
    assert dict(fused.dtypes)["n"] == "bigint" and dict(fused.dtypes)["d"] == "bigint"


def test_sequence_profile_by_the_token_itself(spark):
    """Ordered by its tokens, or without pieces, a sequence is joined in one step and equals the two steps'."""
    rnd = random.Random(5)
    data = [(1, rnd.randint(1, 4), rnd.choice([None, 1, 2]), rnd.choice([None, "x", "y z", "y", ""]), rnd.choice([None, 1, 2]), rnd.choice([None, 1]))
            for _ in range(300)]
    df = spark.createDataFrame(data, "subject_id long, hadm_id long, o int, t string, sev int, mort int")
    top = (["t", "sev", "mort"], ["sev", "mort"], "top")
    for order, more in ((None, {}), ("o", {"pieces": False}), ("o", {})):
        out = agg.sequence_profile(df, K, "t", order, "s", count_name="n", distinct_name="d", top=top, **more)
        steps = out._jdf.queryExecution().optimizedPlan().toString().count("listagg(")
        assert steps == (2 if order and not more else 1)
        by = "o ASC NULLS FIRST, t" if order else "t"
        want = df.groupBy(*K).agg(F.expr(f"listagg(t, ' ') WITHIN GROUP (ORDER BY {by})").alias("s"), F.count("t").alias("n"), F.countDistinct("t").alias("d"))
        want = want.join(agg.top_record(df, K, *top), K)
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
