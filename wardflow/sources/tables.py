"""Clinical table schemas and readers.

A ``Tables`` object hands out the hospital tables as lazy DataFrames. Three
providers exist: stored tables (Parquet folders, one per table, e.g. an export
of the hospital database), tables of the catalog, and the derived test views
built from the TPC-H-like test data (``wardflow.sources.synthetic``). Operators
never care which one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardflow.session import compiled_methods, hashed_joins, narrow_partitions

# Only the columns the features use. Explicit schemas everywhere: codes keep
# leading zeros, times stay civil date-times (TIMESTAMP_NTZ).
SCHEMAS: dict[str, T.StructType] = {
    "patients": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("anchor_age", T.IntegerType()),
        T.StructField("anchor_year", T.IntegerType()),
    ]),
    "admissions": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("admittime", T.TimestampNTZType()),
        T.StructField("dischtime", T.TimestampNTZType()),
        T.StructField("deathtime", T.TimestampNTZType()),
        T.StructField("admission_location", T.StringType()),
        T.StructField("race", T.StringType()),
        T.StructField("hospital_expire_flag", T.IntegerType()),
    ]),
    "diagnoses_icd": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("seq_num", T.IntegerType()),
        T.StructField("icd_code", T.StringType()),
        T.StructField("icd_version", T.IntegerType()),
    ]),
    "procedures_icd": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("chartdate", T.DateType()),
        T.StructField("icd_code", T.StringType()),
    ]),
    "prescriptions": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("drug", T.StringType()),
        T.StructField("starttime", T.TimestampNTZType()),
        T.StructField("stoptime", T.TimestampNTZType()),
    ]),
    "drgcodes": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("drg_type", T.StringType()),
        T.StructField("drg_code", T.StringType()),
        T.StructField("drg_severity", T.IntegerType()),
        T.StructField("drg_mortality", T.IntegerType()),
    ]),
    "emar": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("medication", T.StringType()),
        T.StructField("event_txt", T.StringType()),
    ]),
    "labevents": T.StructType([
        T.StructField("labevent_id", T.LongType()),
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("flag", T.StringType()),
    ]),
    "transfers": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("careunit", T.StringType()),
        T.StructField("intime", T.TimestampNTZType()),
    ]),
}

TABLE_NAMES = tuple(SCHEMAS)


class Tables:
    """Lazy provider of the clinical tables; subclasses implement ``_load``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        narrow_partitions(spark)
        compiled_methods(spark)
        hashed_joins(spark)
        self._cache: dict[str, DataFrame] = {}

    def _load(self, name: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def get(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(f"unknown clinical table {name!r}")
        if name not in self._cache:
            self._cache[name] = self._load(name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return self.get(name)
        raise AttributeError(name)


class ParquetTables(Tables):
    """Stored clinical tables: ``<root>/<table>`` Parquet folders (or files)."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.suffix = suffix

    def _load(self, name: str) -> DataFrame:
        schema = SCHEMAS[name]
        df = self.spark.read.parquet(f"{self.root}/{name}{self.suffix}")
        # Select (and cast) the declared columns: pruning reaches the scan.
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


class CatalogTables(Tables):
    """Clinical tables of the session's catalog: ``<prefix><table>``, or the name given for a table in ``names``."""

    def __init__(self, spark: SparkSession, prefix: str = "", names: dict[str, str] | None = None):
        super().__init__(spark)
        self.prefix, self.names = prefix, names or {}

    def _load(self, name: str) -> DataFrame:
        df = self.spark.table(self.names.get(name, self.prefix + name))
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])


def stage_tables(tables: Tables, out_root: str, names=TABLE_NAMES, partitions: int | None = None) -> ParquetTables:
    """Write every table once to ``out_root`` (optionally spread evenly over
    ``partitions`` files, so later scans run in parallel) and return a
    provider over the copy."""
    for name in names:
        df = tables.get(name)
        if partitions:
            df = df.repartition(partitions)
        df.write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/{name}")
    return ParquetTables(tables.spark, out_root)
