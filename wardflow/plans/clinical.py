"""The hospital feature plans: age, 30-day return label, comorbidity index and
the 30-column feature table, composed from the generic operators.

Every function takes a ``Tables`` provider and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.dates import DAY_UNITS
from wardflow.functions.scores import score_bands, weighted_index
from wardflow.operators import aggregates as agg
from wardflow.operators import codes, temporal
from wardflow.profiles import clinical as P
from wardflow.sources import io
from wardflow.sources.tables import Tables

KEYS = P.STAY_KEYS


# ---------------------------------------------------------------------------
# Derived tables
# ---------------------------------------------------------------------------

def age(t: Tables) -> DataFrame:
    """(subject_id, hadm_id, age): anchor age plus year boundaries since the
    anchor year; stays without a patient row are left out."""
    return temporal.age_at_event(t.admissions, t.patients, P.ENTITY, "admittime",
                                 "anchor_age", "anchor_year", keep=KEYS, name="age")


def readmission(t: Tables, days: int = 30, unit: str = "elapsed", ranges: bool = False) -> DataFrame:
    """(subject_id, hadm_id, dischtime, readmission_flag)."""
    return temporal.returns_within(t.admissions, P.ENTITY, "admittime", "dischtime", P.EPISODE,
                                   days=days, unit=unit, keep=KEYS, ranges=ranges)


def admission_ordinal(t: Tables, ranges: bool = False) -> DataFrame:
    return temporal.episode_ordinal(t.admissions, P.ENTITY, "admittime", P.EPISODE, keep=KEYS, ranges=ranges)


def _visit_weights():
    loc = F.col("admission_location")
    return {
        "num_prev_emergency": loc == P.EMERGENCY_LOCATION,
        "num_prev_non_emergency": ~loc.isin(*P.NON_EMERGENCY_EXCLUDED),
    }


def prev_visits(t: Tables, ranges: bool = False) -> DataFrame:
    adm = t.admissions.select(*KEYS, "admittime", "admission_location")
    scan = temporal.episode_scan(adm, P.ENTITY, "admittime", P.EPISODE, _visit_weights(), ranges)
    return scan.select(*KEYS, *_visit_weights())


def _transfer_weights():
    unit = F.col("careunit")
    return {name: unit.isin(*units) for name, units in P.CAREUNIT_GROUPS.items()}


def prev_transfers(t: Tables, ranges: bool = False) -> DataFrame:
    adm = t.admissions.select(*KEYS, "admittime")
    return temporal.prior_event_counts(adm, t.transfers, P.ENTITY, "admittime", P.EPISODE,
                                       "intime", _transfer_weights(), ranges)


def comorbidity_flags(t: Tables) -> DataFrame:
    """(hadm_id, 17 flags) for every admission; stays without codes get 0."""
    rules = P.parse_rules()
    flags = codes.code_flags(t.diagnoses_icd, P.EPISODE, "icd_code", "icd_version", rules)
    return codes.flags_for_all(t.admissions, flags, P.EPISODE, P.categories(), [P.EPISODE])


def _age_score(col="age"):
    return score_bands(col, P.AGE_SCORE_CUTS)


def _charlson(base="age_score"):
    return weighted_index(base, P.CHARLSON_WEIGHTS, P.CHARLSON_DOMINANCE)


def comorbidity_index(t: Tables, age_table: DataFrame | None = None) -> DataFrame:
    """(subject_id, hadm_id, age_score, 17 flags, charlson_comorbidity_index).

    ``age_table`` is the stored result of ``age`` if there is one. A stay
    without an age row has a NULL age_score and a NULL index; a NULL age
    itself falls into the top band.
    """
    age_table = age(t) if age_table is None else age_table
    rules = P.parse_rules()
    cats = P.categories()
    flags = codes.code_flags(t.diagnoses_icd, P.EPISODE, "icd_code", "icd_version", rules)
    ag = age_table.select(P.EPISODE, _age_score().alias("age_score"))
    base = t.admissions.select(*KEYS).join(_hashed(flags), P.EPISODE, "left").join(ag, P.EPISODE, "left")
    flag_cols = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cats]
    out = base.select(*KEYS, "age_score", *flag_cols)
    return out.withColumn("charlson_comorbidity_index", _charlson())


# ---------------------------------------------------------------------------
# Per-stay event features
# ---------------------------------------------------------------------------

def proc_count(t: Tables) -> DataFrame:
    return agg.count_by_key(t.procedures_icd, KEYS, "icd_code", "num_procedures")


def proc_distinct(t: Tables) -> DataFrame:
    return agg.distinct_by_key(t.procedures_icd, KEYS, "icd_code", "num_unique_procedures")


def diag_distinct(t: Tables) -> DataFrame:
    return agg.distinct_by_key(t.diagnoses_icd, KEYS, "icd_code", "num_unique_icd_codes")


def drug_distinct(t: Tables) -> DataFrame:
    rx = t.prescriptions
    return agg.distinct_by_key(rx, KEYS, "drug", "num_unique_drugs",
                               where=F.col("stoptime") >= F.col("starttime"))


def prescription_totals(t: Tables) -> DataFrame:
    return agg.duration_totals(t.prescriptions, KEYS, "starttime", "stoptime")


def prescription_features(t: Tables) -> DataFrame:
    """num_unique_drugs, num_prescribed_days, num_prescription_records: one
    filter, one aggregate."""
    return agg.duration_totals(t.prescriptions, KEYS, "starttime", "stoptime",
                               distinct_col="drug", distinct_name="num_unique_drugs")


def proc_sequence(t: Tables) -> DataFrame:
    return agg.sequence_by_key(t.procedures_icd, KEYS, "icd_code", "chartdate", "proc_icd_codes")


def diag_sequence(t: Tables) -> DataFrame:
    return agg.sequence_by_key(t.diagnoses_icd, KEYS, "icd_code", "seq_num", "diag_icd_codes")


def _drg_pair():
    return F.concat(F.col("drg_type"), F.lit(" "), F.col("drg_code"))


def drg_sequence(t: Tables) -> DataFrame:
    """'type code' pairs joined by spaces; the source fixes no order, we
    sort by the pair text."""
    return agg.sequence_by_key(t.drgcodes, KEYS, _drg_pair(), _drg_pair(), "drg_concat")


DRG_PAYLOAD = ["drg_code", "drg_type", "drg_severity", "drg_mortality"]
DRG_ORDER = ["drg_severity", "drg_mortality"]


def drg_top(t: Tables) -> DataFrame:
    """The DRG row with the highest (severity, mortality), NULLs last."""
    top = agg.top_record(t.drgcodes, KEYS, DRG_PAYLOAD, DRG_ORDER, "drg_info")
    return top.select(*KEYS, *_drg_top_columns())


def _drg_top_columns():
    return [F.col(f"drg_info.{c}").alias(f"top_{c}") for c in DRG_PAYLOAD]


def emar_count(t: Tables) -> DataFrame:
    return agg.count_by_key(t.emar, KEYS, "medication", "num_emar_medications",
                            where=F.col("event_txt") == "Administered")


def lab_abnormal_count(t: Tables) -> DataFrame:
    return agg.count_by_key(t.labevents, KEYS, "labevent_id", "num_abnormal_labevents",
                            where=F.col("flag") == "abnormal")


# ---------------------------------------------------------------------------
# Fused per-source features: one scan and one aggregate per event table
# ---------------------------------------------------------------------------

def procedure_features(t: Tables) -> DataFrame:
    """num_procedures, num_unique_procedures and proc_icd_codes."""
    return agg.sequence_profile(t.procedures_icd, KEYS, "icd_code", "chartdate", "proc_icd_codes",
                                count_name="num_procedures", distinct_name="num_unique_procedures")


def diagnosis_features(t: Tables) -> DataFrame:
    """num_unique_icd_codes and diag_icd_codes. (``seq_num`` numbers a stay's codes: few share a number.)"""
    return agg.sequence_profile(t.diagnoses_icd, KEYS, "icd_code", "seq_num", "diag_icd_codes",
                                distinct_name="num_unique_icd_codes", pieces=False)


def drg_features(t: Tables) -> DataFrame:
    """drg_concat and the four top-DRG columns."""
    f = agg.sequence_profile(t.drgcodes, KEYS, _drg_pair(), None, "drg_concat",
                             top=(DRG_PAYLOAD, DRG_ORDER, "drg_info"))
    return f.select(*KEYS, "drg_concat", *_drg_top_columns())


# ---------------------------------------------------------------------------
# The feature table
# ---------------------------------------------------------------------------

class _KeyedEvents:
    """The event tables restricted to rows with a stay id. (A row with a stay
    id but no patient id still counts for the flags, which are per stay id.)"""

    def __init__(self, t: Tables):
        self._t = t

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(self._t, name).where(F.col(P.EPISODE).isNotNull())


def _hashed(df: DataFrame) -> DataFrame:
    """A frame of a row per stay as the hashed side of a join: a shuffle deals its rows out evenly, so a task hashes its
    share of them where a merge join would sort both sides."""
    return df.hint("shuffle_hash")


def _masks(keyed: _KeyedEvents) -> DataFrame:
    """The comorbidity mask per stay id, as in the index's own definition."""
    return codes.code_masks(keyed.diagnoses_icd, P.EPISODE, "icd_code", "icd_version", P.parse_rules())


def _ages(t: Tables) -> DataFrame:
    """The ages, and that there is one: a NULL age isn't a missing one."""
    return age(t).withColumn("_aged", F.lit(True))


def _stays(t: Tables, days: int, unit: str, ranges: bool, masks: DataFrame | None = None) -> DataFrame:
    """The admissions with return label, ordinal and prior visits, and the comorbidity mask where ``masks`` are given."""
    adm = t.admissions.select(*KEYS, "race", "admittime", "dischtime", "deathtime",
                              "hospital_expire_flag", "admission_location")
    carried = []
    if masks is not None:
        adm = adm.join(_hashed(masks), P.EPISODE, "left")
        carried = ["_mask"]
    scan = temporal.episode_scan(adm, P.ENTITY, "admittime", P.EPISODE, _visit_weights(), ranges)
    diff = DAY_UNITS[unit]
    return scan.select(
        *KEYS, "race", "admittime", "dischtime", "deathtime", "hospital_expire_flag", *carried,
        F.when(diff(F.col("next_start"), F.col("dischtime")) <= days, 1).otherwise(0).alias("readmission_flag"),
        F.col("ordinal").alias("num_hospital_admissions"),
        *_visit_weights())


#: The per-stay features that come from one event table each.
EVENT_FEATURES = {"procedures": procedure_features, "diagnoses": diagnosis_features, "prescriptions": prescription_features,
                  "drgs": drg_features, "emar": emar_count, "labs": lab_abnormal_count}


def feature_groups(t: Tables, days: int = 30, unit: str = "elapsed", ranges: bool = True) -> dict[str, DataFrame]:
    """All that the feature table is joined from, a frame per source with a row per stay, to be stored: ``model_data`` takes
    the stored copies."""
    keyed = _KeyedEvents(t)
    return {"stays": _stays(t, days, unit, ranges), **{name: make(keyed) for name, make in EVENT_FEATURES.items()},
            "transfers": prev_transfers(t, ranges), "age": age(t),
            "comorbidity_index": comorbidity_index(t).select(*KEYS, "charlson_comorbidity_index")}


def model_data(t: Tables, stored: dict[str, DataFrame] | None = None,
               days: int = 30, unit: str = "elapsed", ranges: bool = False, columns=None) -> DataFrame:
    """One row per living stay, 30 columns (``P.MODEL_DATA_COLUMNS``) or those of them in ``columns``; lazy, unless
    histories are scanned by written ``ranges`` (see ``operators.temporal``): what ``columns`` leaves out isn't scanned then.

    ``stored`` may hold written results of ``readmission``, ``age`` and
    ``comorbidity_index``, or of any of ``feature_groups`` or ``staged_groups``. Otherwise the admissions get the patient's age and
    the comorbidity mask of the stay first, as narrow rows, and the return
    label, the stay ordinal and the prior-visit counts come from one scan over
    them. The death filter comes last: stays that ended in death still count as
    the next stay, as ordinals and as history.
    """
    stored = stored or {}
    columns = list(columns or P.MODEL_DATA_COLUMNS)
    indexed = "charlson_comorbidity_index" in columns
    # Event rows without a stay id join to no stay: they are dropped before
    # aggregating, so they never form one large, useless group (T18).
    keyed = _KeyedEvents(t)
    masks = _masks(keyed) if "comorbidity_index" not in stored and indexed and "stays" not in stored else None
    out = stored["stays"] if "stays" in stored else _stays(t, days, unit, ranges, masks)
    masked = "_mask" in out.columns
    if "readmission" in stored:
        out = out.drop("readmission_flag").join(_hashed(stored["readmission"].select(*KEYS, "readmission_flag")), KEYS, "left")
    for name, make in EVENT_FEATURES.items():
        features = stored[name] if name in stored else _hashed(make(keyed))
        if (set(features.columns) - set(KEYS)) & set(columns):
            out = out.join(features, KEYS, "left")
    if set(P.CAREUNIT_GROUPS) & set(columns):
        out = out.join(stored["transfers"] if "transfers" in stored else _hashed(prev_transfers(t, ranges)), KEYS, "left")

    if "comorbidity_index" in stored:
        age_table = stored["age"] if "age" in stored else age(t)
        out = out.join(age_table.select(*KEYS, "age"), KEYS, "left")
        out = out.join(stored["comorbidity_index"].select(*KEYS, "charlson_comorbidity_index"), KEYS, "left")
    elif indexed or "age" in columns:
        # Ages per stay keys, so that a stay id two patients share finds both; one row for each stay of the scan.
        out = out.join(stored["age"] if "age" in stored else _hashed(_ages(t)), KEYS, "left")
    if masked:
        # A stay without an age row has a NULL index; a NULL age itself is in the top band.
        flags = {c: F.coalesce(F.shiftright("_mask", i).bitwiseAND(1).cast("int"), F.lit(0))
                 for i, c in enumerate(P.categories())}
        out = out.withColumns({**flags, "_age_score": F.when(F.col("_aged"), _age_score())})
        out = out.withColumn("charlson_comorbidity_index", _charlson("_age_score"))

    return out.where(F.col("deathtime").isNull()).select(*columns)


def staged_groups(t: Tables, columns=None, days: int = 30, unit: str = "elapsed", buckets: int | None = None) -> io.Stored:
    """What ``columns`` of the feature table (default: all) are joined from, stored bucketed by the stay keys one group after
    another: the disk holds the shuffles of one group at a time. The largest ones come first, when little is stored."""
    columns = list(columns or P.MODEL_DATA_COLUMNS)
    keyed = _KeyedEvents(t)
    indexed = "charlson_comorbidity_index" in columns
    groups = {}
    if set(P.CAREUNIT_GROUPS) & set(columns):
        groups["transfers"] = lambda: prev_transfers(t, ranges=True)
    groups["stays"] = lambda: _stays(t, days, unit, True, _masks(keyed) if indexed else None)
    for name in ("prescriptions", "drgs", "procedures", "diagnoses", "emar", "labs"):
        groups[name] = lambda make=EVENT_FEATURES[name]: make(keyed)
    if indexed or "age" in columns:
        groups["age"] = lambda: _ages(t)
    kept = {*KEYS, *columns, "deathtime", "_mask", "_aged"}

    def pruned(make):
        df = make()
        return df.select(*[c for c in df.columns if c in kept])

    # What a group has besides the keys says whether it is needed; only histories are worked out when they are made.
    needed = {name: make for name, make in groups.items()
              if name not in EVENT_FEATURES or set(make().columns) & set(columns) - set(KEYS)}
    stored = io.store_in_turn(t.spark, {name: lambda make=make: pruned(make) for name, make in needed.items()}, KEYS, "groups", buckets)
    # Merge joins of what lies side by side; a broadcast would send each group to every task instead.
    for name, df in stored.items():
        stored[name] = df.hint("merge")
    return stored


def model_data_staged(t: Tables, columns=None) -> DataFrame:
    """``model_data`` from groups of features that are worked out and stored one after another (``staged_groups``)."""
    return model_data(t, stored=staged_groups(t, columns), columns=columns)


def model_data_bucketed(t: Tables, buckets: int | None = None) -> DataFrame:
    """The feature table from feature groups stored bucketed by the stay keys: its ten joins shuffle nothing."""
    groups = io.store_bucketed(t.spark, feature_groups(t), KEYS, "features", buckets)
    # Merge joins of what lies side by side; a broadcast would send each group to every task instead.
    return model_data(t, stored={name: df.hint("merge") for name, df in groups.items()})
