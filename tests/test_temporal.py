"""Ordinal, next start, return label and history counts: traps and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardflow.operators import temporal
from wardflow.operators.ordering import in_ranges, numbered
from wardflow.plans import clinical as C
from wardflow.sources.tables import Tables

T = dt.datetime
ADM = ("subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, "
       "deathtime timestamp_ntz, admission_location string, race string, hospital_expire_flag int")


class Fixed(Tables):
    def __init__(self, spark, frames):
        super().__init__(spark)
        self.frames = frames

    def _load(self, name):
        return self.frames[name]


def test_age_counts_year_boundaries(spark):
    adm = spark.createDataFrame([(1, 10, T(2149, 6, 1)), (1, 11, T(2150, 1, 1)), (2, 12, T(2150, 1, 1))],
                                "subject_id long, hadm_id long, admittime timestamp_ntz")
    pat = spark.createDataFrame([(1, 60, 2150)], "subject_id long, anchor_age int, anchor_year int")
    got = {r["hadm_id"]: r["age"] for r in
           temporal.age_at_event(adm, pat, "subject_id", "admittime", "anchor_age", "anchor_year").collect()}
    # 2149-06-01 is one year boundary before 2150 (T1); patient 2 has no row (inner join)
    assert got == {10: 59, 11: 60}


def _adm(spark, rows):
    return spark.createDataFrame(rows, "subject_id long, hadm_id long, admittime timestamp_ntz, "
                                       "dischtime timestamp_ntz")


def test_returns_within_elapsed_and_calendar(spark):
    d0 = T(2100, 1, 1, 20, 0)
    rows = [
        (1, 1, T(2099, 12, 1), d0),
        (1, 2, T(2100, 2, 1, 19, 0), T(2100, 2, 3)),     # 30 d 23 h elapsed (-> 30, T3), 31 calendar days
        (1, 3, T(2100, 3, 5, 18, 0), T(2100, 3, 6)),     # 30 d 18 h after stay 2 ends: 30 in both units
        (2, 4, T(2100, 1, 1), T(2100, 1, 10)),
        (2, 5, T(2100, 1, 5), T(2100, 1, 6)),            # overlaps stay 4 -> negative gap -> 1 (T4)
    ]
    df = _adm(spark, rows)
    el = {r["hadm_id"]: r["readmission_flag"] for r in
          temporal.returns_within(df, "subject_id", "admittime", "dischtime", "hadm_id").collect()}
    ca = {r["hadm_id"]: r["readmission_flag"] for r in
          temporal.returns_within(df, "subject_id", "admittime", "dischtime", "hadm_id", unit="calendar").collect()}
    assert el == {1: 1, 2: 1, 3: 0, 4: 1, 5: 0}
    assert ca == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0}


def test_tie_on_start_broken_by_id(spark):
    rows = [(1, 7, T(2100, 1, 1), T(2100, 1, 2)), (1, 3, T(2100, 1, 1), T(2100, 1, 2)),
            (1, 9, T(2100, 2, 1), T(2100, 2, 2))]
    scan = temporal.episode_scan(_adm(spark, rows), "subject_id", "admittime", "hadm_id")
    got = {r["hadm_id"]: (r["ordinal"], r["next_start"]) for r in scan.collect()}
    assert got == {3: (1, T(2100, 1, 1)), 7: (2, T(2100, 2, 1)), 9: (3, None)}


def brute_scan(rows, weights):
    out = {}
    for e, h, s, w in rows:
        same = [x for x in rows if x[0] == e]
        order = sorted(same, key=lambda x: ((x[2] is not None, x[2]), x[1]))
        pos = [x[1] for x in order].index(h)
        nxt = order[pos + 1][2] if pos + 1 < len(order) else None
        prior = {k: sum(1 for x in same if s is not None and x[2] is not None and x[2] < s and f(x[3]))
                 for k, f in weights.items()}
        out[h] = (pos + 1, nxt, prior)
    return out


@pytest.mark.parametrize("ranges", [False, True])
def test_episode_scan_brute_force_with_hot_entity(spark, ranges):
    rnd = random.Random(7)
    rows, h = [], 0
    for e in range(1, 6):
        n = 200 if e == 1 else rnd.randint(1, 8)         # entity 1 is hot, spread over many days
        for _ in range(n):
            h += 1
            s = None if rnd.random() < 0.03 else T(2100, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 40))
            loc = rnd.choice(["EMERGENCY ROOM", "INTERNAL TRANSFER TO OR FROM PSYCH", "PHYSICIAN REFERRAL", None])
            rows.append((e, h, s, loc))
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, admittime timestamp_ntz, loc string")
    loc = F.col("loc")
    scan = temporal.episode_scan(df, "subject_id", "admittime", "hadm_id",
                                 {"er": loc == "EMERGENCY ROOM",
                                  "non_er": ~loc.isin("EMERGENCY ROOM", "INTERNAL TRANSFER TO OR FROM PSYCH")}, ranges)
    got = {r["hadm_id"]: (r["ordinal"], r["next_start"], {"er": r["er"], "non_er": r["non_er"]})
           for r in scan.collect()}
    exp = brute_scan(rows, {"er": lambda v: v == "EMERGENCY ROOM",
                            "non_er": lambda v: v is not None and v not in
                            ("EMERGENCY ROOM", "INTERNAL TRANSFER TO OR FROM PSYCH")})
    assert got == exp


@pytest.mark.parametrize("ranges", [False, True])
def test_prior_event_counts_brute_force(spark, ranges):
    rnd = random.Random(11)
    eps, evs, h = [], [], 0
    for e in range(1, 5):
        for _ in range(rnd.randint(1, 6)):
            h += 1
            eps.append((e, h, T(2100, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 20))))
        for _ in range(300 if e == 1 else rnd.randint(0, 30)):
            t = None if rnd.random() < 0.05 else T(2100, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 20))
            evs.append((e, rnd.choice(["A", "B", None]), t))
    # an episode starting exactly at an event time: that event is not earlier (T7)
    eps.append((1, 999, evs[0][2] or T(2100, 1, 5)))
    ep = spark.createDataFrame(eps, "subject_id long, hadm_id long, admittime timestamp_ntz")
    ev = spark.createDataFrame(evs, "subject_id long, unit string, intime timestamp_ntz")
    got = {r["hadm_id"]: (r["a"], r["b"]) for r in temporal.prior_event_counts(
        ep, ev, "subject_id", "admittime", "hadm_id", "intime",
        {"a": F.col("unit") == "A", "b": F.col("unit").isin("B")}, ranges).collect()}
    for e, h, s in eps:
        exp = tuple(sum(1 for x in evs if x[0] == e and x[2] is not None and x[2] < s and x[1] == u)
                    for u in ("A", "B"))
        assert got[h] == exp, h


def _hot_rows(n=3000):
    """A third of all rows on one day of one entity, most of them at one moment of it; NULL entities and times."""
    rnd = random.Random(3)
    rows = []
    for h in range(n):
        kind = h % 6
        if kind < 2:
            e, s = 1, T(2100, 1, 5, 12 if rnd.random() < 0.7 else rnd.randint(0, 23))
        elif kind == 2:
            e, s = 1, T(2100, 1, 1) + dt.timedelta(hours=rnd.randint(0, 240))
        else:
            e = rnd.choice([None, None, 0, *range(2, 40)])
            s = None if rnd.random() < 0.05 else T(2100, 1, 1) + dt.timedelta(hours=rnd.randint(0, 48))
        rows.append((e, h, s, rnd.choice(["a", "b", None])))
    return rows


def test_a_hot_day_is_spread_over_ranges(spark):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "e long, h long, s timestamp_ntz, w string").repartition(5)
    weights = {"a": F.col("w") == "a", "b": F.col("w") == "b"}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["h"]: r for r in temporal.episode_scan(df, "e", "s", "h", weights, ranges=True).collect()}
        places = in_ranges(df, [F.col(c).asc_nulls_first() for c in ("e", "s", "h")]).groupBy("_range").agg(
            F.count("*").alias("n"), F.sum(F.expr("if(e = 1 and s = timestamp_ntz'2100-01-05 12:00:00', 1, 0)")).alias("hot")).collect()
        events = temporal.prior_event_counts(df.where("h % 3 = 0"), df.selectExpr("e", "s as t", "w"), "e", "s", "h", "t", weights, ranges=True)
        counts = {r["h"]: (r["a"], r["b"]) for r in events.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(places) > 8 and max(r["n"] for r in places) < len(rows) / 4
    assert sum(r["hot"] > 0 for r in places) >= 3  # one moment of one entity, in several ranges
    by_entity = {}
    for r in rows:
        by_entity.setdefault(r[0], []).append(r)
    assert len(got) == len(rows)
    for e, own in by_entity.items():
        own = sorted(own, key=lambda r: ((r[2] is not None, r[2]), r[1]))
        for i, (_, h, s, _) in enumerate(own):
            r = got[h]
            assert (r["ordinal"], r["next_start"]) == (i + 1, own[i + 1][2] if i + 1 < len(own) else None), (e, i)
            earlier = [x for x in own if e is not None and s is not None and x[2] is not None and x[2] < s]
            exp = tuple(sum(x[3] == w for x in earlier) for w in "ab")
            assert (r["a"], r["b"]) == exp, (e, i)
            if h % 3 == 0:
                assert counts[h] == exp, (e, i)


def test_numbers_over_ranges(spark):
    df = spark.range(0, 5000).selectExpr("(id * 7919) % 5000 as v", "id").repartition(6)
    rows = numbered(df, [F.col("v").desc()]).collect()
    assert all(r["number"] == 5000 - r["v"] for r in rows) and len(rows) == 5000


def test_death_filter_comes_last(spark):
    adm = spark.createDataFrame([
        (1, 1, T(2100, 1, 1), T(2100, 1, 2), None, "EMERGENCY ROOM", "X", 0),
        (1, 2, T(2100, 1, 10), T(2100, 1, 12), T(2100, 1, 12), "EMERGENCY ROOM", "X", 1),
        (1, 3, T(2100, 1, 20), T(2100, 1, 21), None, None, "X", 0),
    ], ADM)
    empty = {
        "patients": spark.createDataFrame([(1, 50, 2100)], "subject_id long, anchor_age int, anchor_year int"),
        "diagnoses_icd": spark.createDataFrame([], "subject_id long, hadm_id long, seq_num int, icd_code string, icd_version int"),
        "procedures_icd": spark.createDataFrame([], "subject_id long, hadm_id long, chartdate date, icd_code string"),
        "prescriptions": spark.createDataFrame([], "subject_id long, hadm_id long, drug string, starttime timestamp_ntz, stoptime timestamp_ntz"),
        "drgcodes": spark.createDataFrame([], "subject_id long, hadm_id long, drg_type string, drg_code string, drg_severity int, drg_mortality int"),
        "emar": spark.createDataFrame([], "subject_id long, hadm_id long, medication string, event_txt string"),
        "labevents": spark.createDataFrame([], "labevent_id long, subject_id long, hadm_id long, flag string"),
        "transfers": spark.createDataFrame([], "subject_id long, careunit string, intime timestamp_ntz"),
        "admissions": adm,
    }
    md = C.model_data(Fixed(spark, empty))
    got = {r["hadm_id"]: r for r in md.collect()}
    assert set(got) == {1, 3}                                   # stay 2 ended in death
    assert got[1]["readmission_flag"] == 1                      # the stay that ended in death is still "next"
    assert got[3]["num_hospital_admissions"] == 3               # and still counts as an earlier stay
    assert got[3]["num_prev_emergency"] == 2
    assert got[3]["num_prev_non_emergency"] == 0
    assert got[1]["num_procedures"] is None                     # absent features stay NULL (T19)
    assert got[1]["num_prev_general_practice"] == 0             # history counts are 0, never NULL
    assert got[1]["charlson_comorbidity_index"] == 0 and got[1]["age"] == 50
    assert md.columns == C.P.MODEL_DATA_COLUMNS
    assert {f.name: f.dataType.simpleString() for f in md.schema.fields} == C.P.MODEL_DATA_TYPES


def test_feature_table_flags_per_stay_id_and_null_stay_events(spark):
    """Flags follow the stay id alone (a diagnosis row without patient id still
    counts); events without a stay id change nothing; the fused features equal
    the standalone queries."""
    adm = spark.createDataFrame([
        (1, 1, T(2100, 1, 1), T(2100, 1, 2), None, "EMERGENCY ROOM", "X", 0),
        (1, 2, T(2100, 2, 1), T(2100, 2, 3), None, "PHYSICIAN REFERRAL", "X", 0),
    ], ADM)
    dx = spark.createDataFrame([
        (1, 1, 1, "I21", 10), (None, 1, 2, "B20", 10), (1, 1, 2, "4254", 9), (1, 1, 3, "7999", 9),
        (1, None, 1, "042", 9), (1, 2, 1, None, 10),
    ], "subject_id long, hadm_id long, seq_num int, icd_code string, icd_version int")
    frames = {
        "patients": spark.createDataFrame([(1, 50, 2100)], "subject_id long, anchor_age int, anchor_year int"),
        "diagnoses_icd": dx,
        "procedures_icd": spark.createDataFrame(
            [(1, 1, dt.date(2100, 1, 1), "P1"), (1, 1, dt.date(2100, 1, 1), "P1"), (1, None, None, "P9")],
            "subject_id long, hadm_id long, chartdate date, icd_code string"),
        "prescriptions": spark.createDataFrame([], "subject_id long, hadm_id long, drug string, starttime timestamp_ntz, stoptime timestamp_ntz"),
        "drgcodes": spark.createDataFrame(
            [(1, 1, "HCFA", "100", 2, 3), (1, 1, "APR", "200", 2, 4), (1, None, "APR", "900", 9, 9)],
            "subject_id long, hadm_id long, drg_type string, drg_code string, drg_severity int, drg_mortality int"),
        "emar": spark.createDataFrame([], "subject_id long, hadm_id long, medication string, event_txt string"),
        "labevents": spark.createDataFrame([(1, 1, None, "abnormal")], "labevent_id long, subject_id long, hadm_id long, flag string"),
        "transfers": spark.createDataFrame([], "subject_id long, careunit string, intime timestamp_ntz"),
        "admissions": adm,
    }
    t = Fixed(spark, frames)
    got = {r["hadm_id"]: r for r in C.model_data(t).collect()}
    s1 = got[1]
    # age band 0 + myocardial infarct 1 + heart failure 1 + AIDS 6 (the AIDS row has no patient id)
    assert s1["charlson_comorbidity_index"] == 8
    assert s1["diag_icd_codes"] == "I21 4254 7999"       # the row without patient id is its own (NULL, 1) group
    assert s1["num_unique_icd_codes"] == 3
    assert (s1["num_procedures"], s1["num_unique_procedures"], s1["proc_icd_codes"]) == (2, 1, "P1 P1")
    assert (s1["top_drg_code"], s1["top_drg_type"], s1["drg_concat"]) == ("200", "APR", "APR 200 HCFA 100")
    assert s1["num_abnormal_labevents"] is None
    s2 = got[2]
    assert s2["diag_icd_codes"] is None and s2["num_unique_icd_codes"] == 0
    assert s2["charlson_comorbidity_index"] == 0
    ci = {r["hadm_id"]: r for r in C.comorbidity_index(t).collect()}
    assert (ci[1]["myocardial_infarct"], ci[1]["aids"], ci[1]["congestive_heart_failure"]) == (1, 1, 1)
    for h in (1, 2):
        assert got[h]["charlson_comorbidity_index"] == ci[h]["charlson_comorbidity_index"]


def test_rows_without_an_entity(spark):
    """Ordinals and next starts treat them as one entity (PARTITION BY), histories as none (=)."""
    rows = [(None, 1, T(2100, 1, 1), "EMERGENCY ROOM"), (None, 2, T(2100, 1, 1, 5), "EMERGENCY ROOM"), (None, 3, T(2100, 2, 1), None),
            (7, 4, T(2100, 1, 1), "EMERGENCY ROOM"), (7, 5, T(2100, 1, 2), None)]
    adm = spark.createDataFrame(rows, "subject_id long, hadm_id long, admittime timestamp_ntz, admission_location string")
    got = {r["hadm_id"]: r for r in temporal.episode_scan(adm, "subject_id", "admittime", "hadm_id", {
        "w": F.col("admission_location") == "EMERGENCY ROOM"}).collect()}
    assert {k: r["ordinal"] for k, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2}
    assert got[1]["next_start"] == T(2100, 1, 1, 5) and got[2]["next_start"] == T(2100, 2, 1) and got[3]["next_start"] is None
    assert {k: r["w"] for k, r in got.items()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1}
    moves = spark.createDataFrame([(None, T(2099, 1, 1), "u"), (7, T(2099, 1, 1), "u"), (7, None, "u")],
                                  "subject_id long, intime timestamp_ntz, careunit string")
    counts = temporal.prior_event_counts(adm, moves, "subject_id", "admittime", "hadm_id", "intime", {"n": F.col("careunit") == "u"})
    assert {r["hadm_id"]: r["n"] for r in counts.collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}


def test_a_day_of_many_events_equals_the_join(spark):
    rnd = random.Random(9)
    day = T(2100, 5, 5)
    adm = spark.createDataFrame([(s, 10 * s + k, day + dt.timedelta(hours=rnd.randint(0, 30))) for s in (1, 2) for k in range(6)],
                                "subject_id long, hadm_id long, admittime timestamp_ntz")
    moves = spark.createDataFrame(
        [(rnd.choice([1, 1, 1, 2, 3]), day + dt.timedelta(hours=rnd.randint(-30, 40)), rnd.choice("uvw")) for _ in range(2000)],
        "subject_id long, intime timestamp_ntz, careunit string")
    weights = {"u": F.col("careunit") == "u", "vw": F.col("careunit").isin("v", "w")}
    got = temporal.prior_event_counts(adm, moves, "subject_id", "admittime", "hadm_id", "intime", weights)
    joined = adm.join(moves, (adm["subject_id"] == moves["subject_id"]) & (F.col("intime") < F.col("admittime")), "left").groupBy(
        adm["subject_id"], "hadm_id").agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in weights.items()])
    key = lambda r: (r["subject_id"], r["hadm_id"], r["u"], r["vw"])
    assert sorted(map(key, got.collect())) == sorted(map(key, joined.collect()))
