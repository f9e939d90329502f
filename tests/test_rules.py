"""Comorbidity rule table: parsing, every listed value, range ends and neighbours."""

from wardflow.operators import codes
from wardflow.profiles import clinical as P


def python_flags(code, version):
    """Brute-force reference evaluation of the rule text."""
    out = set()
    if code is None or version is None:
        return out
    for r in P.parse_rules():
        if r.version != version:
            continue
        head = code[: r.prefix_len]
        if (r.values and head in r.values) or (not r.values and r.lo <= head <= r.hi):
            out.add(r.category)
    return out


def test_rule_table_shape():
    rules = P.parse_rules()
    cats = P.categories()
    assert len(cats) == 17
    assert cats[0] == "myocardial_infarct" and cats[-1] == "aids"
    n_values = sum(len(r.values) if r.values else 1 for r in rules)
    assert n_values == 309
    assert {r.version for r in rules} == {9, 10}


def _probe_codes():
    out = []
    for r in P.parse_rules():
        if r.values:
            for v in r.values:
                out += [(v, r.version), (v + "9", r.version), (v, 19 - r.version)]
        else:
            out += [(r.lo, r.version), (r.hi, r.version), (r.lo + "X", r.version), (r.hi + "X", r.version)]
            # neighbours just outside the range, and a short code that is a prefix of the bounds
            out += [(r.lo[:-1] + chr(ord(r.lo[-1]) - 1), r.version), (r.hi[:-1] + chr(ord(r.hi[-1]) + 1), r.version),
                    (r.lo[:-1], r.version)]
    out += [("425", 9), (None, 9), ("410", None), ("", 9), ("I2", 10)]
    return sorted(set(out), key=lambda x: (str(x[0]), str(x[1])))


def test_flags_match_brute_force(spark):
    probes = _probe_codes()
    data = [(i, c, v) for i, (c, v) in enumerate(probes)]
    df = spark.createDataFrame(data, "hadm_id long, icd_code string, icd_version int")
    flags = codes.code_flags(df, "hadm_id", "icd_code", "icd_version", P.parse_rules())
    got = {r["hadm_id"]: {c for c in P.categories() if r[c] == 1} for r in flags.collect()}
    for i, (c, v) in enumerate(probes):
        assert got.get(i, set()) == python_flags(c, v), (c, v)


def test_short_code_outside_range(spark):
    # '425' is not between '4254' and '4259' (T12), but '4254' is
    df = spark.createDataFrame([(1, "425", 9), (2, "42541", 9)], "hadm_id long, icd_code string, icd_version int")
    f = {r["hadm_id"]: r["congestive_heart_failure"] for r in
         codes.code_flags(df, "hadm_id", "icd_code", "icd_version", P.parse_rules()).collect()}
    assert f.get(1, 0) == 0 and f[2] == 1


def test_flags_per_stay_any_match_and_zero_fill(spark):
    dx = spark.createDataFrame(
        [(1, "410", 9), (1, "0000", 9), (2, "I50", 9), (3, None, 10)],
        "hadm_id long, icd_code string, icd_version int")
    adm = spark.createDataFrame([(1,), (2,), (3,), (4,)], "hadm_id long")
    flags = codes.code_flags(dx, "hadm_id", "icd_code", "icd_version", P.parse_rules())
    full = codes.flags_for_all(adm, flags, "hadm_id", P.categories(), ["hadm_id"])
    res = {r["hadm_id"]: r for r in full.collect()}
    assert res[1]["myocardial_infarct"] == 1
    # an ICD-10 code under version 9 matches nothing; NULL code and no codes give zeros
    for k in (2, 3, 4):
        assert all(res[k][c] == 0 for c in P.categories())


# Written down by hand from the published category definitions, not from the rule text.
EXPECTED = {
    (9, "4109"): {"myocardial_infarct"}, (9, "412"): {"myocardial_infarct"}, (10, "I219"): {"myocardial_infarct"},
    (10, "I252"): {"myocardial_infarct"}, (10, "I251"): set(), (9, "42821"): {"congestive_heart_failure"},
    (9, "4255"): {"congestive_heart_failure"}, (9, "4253"): set(), (9, "425"): set(), (10, "I50"): {"congestive_heart_failure"},
    (9, "4404"): {"peripheral_vascular_disease"}, (9, "4430"): set(), (9, "4435"): {"peripheral_vascular_disease"},
    (10, "Z959"): {"peripheral_vascular_disease"}, (9, "438"): {"cerebrovascular_disease"}, (9, "439"): set(),
    (10, "G459"): {"cerebrovascular_disease"}, (10, "I69"): {"cerebrovascular_disease"}, (10, "I59"): set(),
    (9, "2900"): {"dementia"}, (10, "G301"): {"dementia"}, (9, "496"): {"chronic_pulmonary_disease"}, (9, "506"): set(),
    (10, "J47"): {"chronic_pulmonary_disease"}, (10, "J48"): set(), (10, "J67"): {"chronic_pulmonary_disease"},
    (9, "7140"): {"rheumatic_disease"}, (10, "M329"): {"rheumatic_disease"}, (9, "5339"): {"peptic_ulcer_disease"},
    (10, "K289"): {"peptic_ulcer_disease"}, (9, "5712"): {"mild_liver_disease"}, (9, "5722"): {"severe_liver_disease"},
    (9, "5729"): set(), (10, "K704"): {"severe_liver_disease"}, (10, "K703"): {"mild_liver_disease"},
    (9, "25000"): {"diabetes_without_cc"}, (9, "25040"): {"diabetes_with_cc"}, (10, "E119"): {"diabetes_without_cc"},
    (10, "E112"): {"diabetes_with_cc"}, (9, "3429"): {"paraplegia"}, (10, "G82"): {"paraplegia"}, (9, "585"): {"renal_disease"},
    (9, "5834"): {"renal_disease"}, (9, "5838"): set(), (10, "N189"): {"renal_disease"}, (9, "1729"): {"malignant_cancer"},
    (9, "173"): set(), (9, "1741"): {"malignant_cancer"}, (9, "1959"): set(), (10, "C26"): {"malignant_cancer"}, (10, "C27"): set(),
    (10, "C77"): {"metastatic_solid_tumor"}, (9, "1979"): {"metastatic_solid_tumor"}, (9, "042"): {"aids"}, (9, "045"): set(),
    (10, "B20"): {"aids"}, (10, "B23"): set(), (10, "410"): set(), (9, "I21"): set(),
}


def test_known_codes(spark):
    rows = [(i, code, version) for i, (version, code) in enumerate(EXPECTED)]
    df = spark.createDataFrame(rows, "hadm_id long, icd_code string, icd_version int")
    got = {r["hadm_id"]: {c for c in P.categories() if r[c] == 1} for r in
           codes.code_flags(df, "hadm_id", "icd_code", "icd_version", P.parse_rules()).collect()}
    for i, want in enumerate(EXPECTED.values()):
        assert got.get(i, set()) == want, rows[i]


def test_masks_join_without_broadcast_too(spark):
    df = spark.createDataFrame([(i, c, v) for i, (v, c) in enumerate(EXPECTED)], "hadm_id long, icd_code string, icd_version int")
    masks = lambda: sorted((r["hadm_id"], r["_mask"]) for r in
                           codes.code_masks(df, "hadm_id", "icd_code", "icd_version", P.parse_rules()).collect())
    spread = masks()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert masks() == spread
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_masks_are_worked_out_once_a_row(spark):
    """No filter before the aggregate repeats the rules; stays whose codes match nothing still get no row."""
    from wardflow.operators.codes import code_masks
    df = spark.createDataFrame([(1, "4255", 9), (1, "I21", 10), (2, "7999", 9), (3, None, 9), (4, "C35", 10), (5, "C34", 10)],
                               "hadm_id long, icd_code string, icd_version int")
    masks = code_masks(df, "hadm_id", "icd_code", "icd_version", P.parse_rules())
    assert masks._jdf.queryExecution().optimizedPlan().toString().count("4259") == 1
    assert {r["hadm_id"] for r in masks.collect()} == {1, 5}


def test_ranges_that_overlap_are_in_apart_cases(spark):
    from pyspark.sql import functions as F

    from wardflow.operators.codes import range_mask
    rules = [P.CodeRule(c, v, n, (), lo, hi) for c, v, n, lo, hi in
             [("a", 9, 3, "100", "199"), ("b", 9, 3, "150", "250"), ("a", 9, 3, "300", "310"), ("c", 9, 4, "1500", "1509"), ("c", 10, 3, "A00", "A09")]]
    df = spark.createDataFrame([("1501", 9), ("100", 9), ("200", 9), ("305", 9), ("A05", 10), ("A05", 9), ("1501", 10), (None, 9), ("1501", None)], "c string, v int")
    got = [r[0] for r in df.select(F.coalesce(range_mask(rules, "c", "v"), F.lit(0))).collect()]
    assert got == [1 | 2 | 4, 1, 2, 1, 4, 0, 0, 0, 0]
