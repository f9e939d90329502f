"""Clinical tables derived from the TPC-H-like test data.

The hospital database itself is licensed and not distributed, so tests and
benchmarks map the test tables onto the hospital schema: customer -> patients,
orders -> admissions, lineitem -> diagnoses / procedures / prescriptions /
drgcodes / transfers, events -> emar / labevents. The mapping deliberately puts
in NULLs, ties, overlapping and reversed intervals, stays without a patient row
and events without a stay, because the base tables have none of these.

The same definitions exist as SQL text in ``wardflow.checks.views_sql`` for the
DuckDB oracle; ``tests/test_views.py`` keeps the two equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.tables import Tables

# FIXED VALUES: seed codes of the derived diagnoses (index, ICD version, code).
# At least one code per Charlson category and version, range ends, and
# non-matching neighbours such as '425' (short code outside '4254'..'4259').
DIAGNOSIS_SEED = [
    (9, "410"), (9, "428"), (9, "39891"), (9, "4254"), (9, "4259"), (9, "425"), (9, "440"), (9, "0930"),
    (9, "4431"), (9, "430"), (9, "36234"), (9, "290"), (9, "2941"), (9, "490"), (9, "505"), (9, "4168"),
    (9, "725"), (9, "4465"), (9, "531"), (9, "570"), (9, "0706"), (9, "07022"), (9, "2500"), (9, "2504"),
    (9, "342"), (9, "3341"), (9, "582"), (9, "5880"), (9, "5830"), (9, "40301"), (9, "140"), (9, "172"),
    (9, "1740"), (9, "2000"), (9, "2386"), (9, "4560"), (9, "5722"), (9, "196"), (9, "042"), (9, "V56"),
    (9, "V427"), (9, "7999"), (10, "I21"), (10, "I252"), (10, "I43"), (10, "I099"), (10, "I70"), (10, "I731"),
    (10, "G45"), (10, "I60"), (10, "H340"), (10, "F00"), (10, "F051"), (10, "J40"), (10, "I278"), (10, "M05"),
    (10, "M315"), (10, "K25"), (10, "B18"), (10, "K700"), (10, "E100"), (10, "E102"), (10, "G81"), (10, "G041"),
    (10, "N18"), (10, "I120"), (10, "C43"), (10, "C00"), (10, "C26"), (10, "I850"), (10, "C77"), (10, "B20"),
    (10, "B23"), (10, "Z999"),
]


def _hours(col, n):
    return F.timestamp_add("HOUR", n, col)


class SyntheticTables(Tables):
    """Derived hospital tables over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- helpers -----------------------------------------------------------
    def _lines_with_subject(self, *cols: str) -> DataFrame:
        """lineitem rows with the owning customer of their order."""
        orders = self.base("orders").select("o_orderkey", "o_custkey")
        return self.base("lineitem").select(*cols).join(
            orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _events_with_order(self) -> DataFrame:
        orders = self.base("orders").select("o_orderkey", "o_custkey")
        ev = self.base("events").select("event_id", "user_id", "event_type", "value")
        return ev.join(orders, (F.col("event_id") - F.col("event_id") % 5) == F.col("o_orderkey"))

    # -- tables ------------------------------------------------------------
    def _load(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _patients(self) -> DataFrame:
        c = self.base("customer")
        key = F.col("c_custkey")
        return c.where(key % 101 != 100).select(
            key.alias("subject_id"),
            (18 + key % 73).cast("int").alias("anchor_age"),
            (1994 + key % 9).cast("int").alias("anchor_year"))

    def _admissions(self) -> DataFrame:
        o = self.base("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        c = self.base("customer").select("c_custkey", "c_mktsegment")
        k = F.col("o_orderkey")
        disch = _hours(F.col("o_orderdate"), k % 24 + 24 * (1 + k % 10) + k % 7)
        dies = k % 50 == 0
        location = (F.when(F.col("o_orderpriority") == "1-URGENT", "EMERGENCY ROOM")
                    .when(F.col("o_orderpriority") == "2-HIGH", "INTERNAL TRANSFER TO OR FROM PSYCH")
                    .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
                    .otherwise("PHYSICIAN REFERRAL"))
        return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_custkey").alias("subject_id"),
            k.alias("hadm_id"),
            _hours(F.col("o_orderdate"), k % 24).alias("admittime"),
            disch.alias("dischtime"),
            F.when(dies, disch).alias("deathtime"),
            location.alias("admission_location"),
            F.col("c_mktsegment").alias("race"),
            F.when(dies, 1).otherwise(0).alias("hospital_expire_flag"))

    def _diagnoses_icd(self) -> DataFrame:
        idx = (F.col("l_partkey") * 31 + F.col("l_suppkey")) % len(DIAGNOSIS_SEED) + 1
        versions = F.array(*[F.lit(v) for v, _ in DIAGNOSIS_SEED])
        codes = F.array(*[F.lit(c) for _, c in DIAGNOSIS_SEED])
        li = self._lines_with_subject("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        return li.select(
            F.col("o_custkey").alias("subject_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_linenumber").alias("seq_num"),
            F.element_at(codes, idx.cast("int")).alias("icd_code"),
            F.element_at(versions, idx.cast("int")).cast("int").alias("icd_version"))

    def _procedures_icd(self) -> DataFrame:
        li = self._lines_with_subject("l_orderkey", "l_partkey", "l_shipdate")
        pk = F.col("l_partkey")
        return li.select(
            F.col("o_custkey").alias("subject_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_shipdate").cast("date").alias("chartdate"),
            F.when(pk % 97 != 0, F.concat(F.lit("P"), (pk % 50).cast("string"))).alias("icd_code"))

    def _prescriptions(self) -> DataFrame:
        li = self._lines_with_subject("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
        part = self.base("part").select("p_partkey", "p_name")
        li = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
        return li.select(
            F.col("o_custkey").alias("subject_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("p_name").alias("drug"),
            F.col("l_shipdate").alias("starttime"),
            F.when(F.col("l_suppkey") % 31 != 0,
                   _hours(F.col("l_shipdate"), F.col("l_linenumber") * 20 - 30)).alias("stoptime"))

    def _drgcodes(self) -> DataFrame:
        li = self._lines_with_subject("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
        known = F.col("l_returnflag") != "A"
        return li.select(
            F.col("o_custkey").alias("subject_id"),
            F.col("l_orderkey").alias("hadm_id"),
            F.col("l_returnflag").alias("drg_type"),
            F.col("l_partkey").cast("string").alias("drg_code"),
            F.when(known, (F.col("l_linenumber") % 4 + 1).cast("int")).alias("drg_severity"),
            F.when(known, (F.col("l_suppkey") % 4 + 1).cast("int")).alias("drg_mortality"))

    def _emar(self) -> DataFrame:
        ev = self._events_with_order()
        et = F.col("event_type")
        return ev.select(
            F.col("o_custkey").alias("subject_id"),
            F.col("o_orderkey").alias("hadm_id"),
            F.when(F.col("event_id") % 13 != 0,
                   F.concat(F.lit("med"), (F.col("user_id") % 20).cast("string"))).alias("medication"),
            F.when(et.isin("purchase", "click"), "Administered")
             .when(et == "view", "Not Given").alias("event_txt"))

    def _labevents(self) -> DataFrame:
        ev = self._events_with_order()
        return ev.select(
            F.col("event_id").alias("labevent_id"),
            F.col("o_custkey").alias("subject_id"),
            F.when(F.col("event_type") != "signup", F.col("o_orderkey")).alias("hadm_id"),
            F.when(F.col("value") > 5, "abnormal").alias("flag"))

    def _transfers(self) -> DataFrame:
        li = self._lines_with_subject("l_orderkey", "l_linenumber", "l_shipdate")
        ln = F.col("l_linenumber")
        unit = (F.when(ln == 1, "Med/Surg").when(ln == 2, "Surgery").when(ln == 3, "Medicine")
                .when(ln == 4, F.lit(None).cast("string")).otherwise("PACU"))
        return li.select(
            F.col("o_custkey").alias("subject_id"),
            unit.alias("careunit"),
            F.col("l_shipdate").alias("intime"))


def tables(spark: SparkSession, sf_dir: str) -> SyntheticTables:
    return SyntheticTables(spark, sf_dir)
