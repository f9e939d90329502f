"""Writers and readers for derived tables and the exported feature frame.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``
(see ``wardflow.session.shared_dir``), never to a machine-local folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardflow.profiles import clinical as P
from wardflow.session import drop_path, scratch, shared_dir, shuffles_dropped

# What stands for NULL in our files; no code or name is spelt like this.
NULL_MARK = "\\N"
# Text comes back as it was: quotes are doubled, blanks kept, line breaks quoted,
# and NULL (its mark) differs from an empty string.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
               "nullValue": NULL_MARK, "lineSep": "\n"}


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def store_and_reload(spark: SparkSession, frames: dict[str, DataFrame], name: str = "derived") -> dict[str, DataFrame]:
    """Write each frame as a Parquet table under one new shared folder and
    return readers over the written copies (lineage is cut there)."""
    root = shared_dir(spark, name)
    out = {}
    for key, df in frames.items():
        path = write_parquet(df, f"{root}/{key}")
        out[key] = spark.read.parquet(path)
    return out


TABLE_PREFIX = "wardflow_stored_"


def store_bucketed(spark: SparkSession, frames: dict[str, DataFrame], keys: list[str], name: str = "bucketed",
                   buckets: int | None = None) -> dict[str, DataFrame]:
    """Write each frame bucketed and sorted by ``keys`` under one new shared folder and return readers over the copies.

    Copies of the same number of buckets are joined, grouped and scanned by those keys without a shuffle, as often as
    they are read. ``buckets`` is the number of shuffle partitions by default: what the session holds right for its
    largest shuffle. Each is written by one task, so it is one file. The tables are in the session's catalog until
    ``drop_bucketed``; their files are in the shared folder.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = shared_dir(spark, name)
    return {key: _bucketed(spark, df, keys, root, key, buckets)[1] for key, df in frames.items()}


def _bucketed(spark: SparkSession, df: DataFrame, keys: list[str], root: str, key: str, buckets: int, **options) -> tuple[str, DataFrame]:
    mark = "".join(c if c.isalnum() else "_" for c in root.rsplit("/", 1)[-1])
    table = f"{TABLE_PREFIX}{mark}_{key}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).options(**options)
     .option("path", f"{root}/{key}").saveAsTable(table))
    return table, spark.table(table)


class Stored(dict):
    """Readers over tables that were stored in turn (see ``store_in_turn``)."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark, self.root, self.tables = spark, root, []

    def drop(self) -> None:
        """Take the tables out of the catalog and remove their files; results still to be read must not need them."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        drop_path(self.spark, self.root)
        self.clear()


def store_in_turn(spark: SparkSession, frames: dict[str, Callable[[], DataFrame]], keys: list[str], name: str = "groups",
                  buckets: int | None = None) -> Stored:
    """``store_bucketed`` for frames that are made one after another: what a frame needed on disk on its way (shuffle files,
    tables written by its steps) is gone before the next one is made, so the disk holds that of one frame and the stored
    copies. In one plan over all frames it would hold the shuffle files of all."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = Stored(spark, shared_dir(spark, name))
    for key, make in frames.items():
        with scratch(spark), shuffles_dropped(spark):
            table, out[key] = _bucketed(spark, make(), keys, out.root, key, buckets, compression="zstd")
            out.tables.append(table)
    return out


def drop_bucketed(spark: SparkSession) -> list[str]:
    """Take the tables of ``store_bucketed`` out of the catalog; results still to be read must not need them. (Their files go
    with ``session.drop_shared``.)"""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(TABLE_PREFIX)]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    return names


def model_data_schema(with_index: bool = False) -> T.StructType:
    fields = [T.StructField(c, T._parse_datatype_string(P.MODEL_DATA_TYPES[c])) for c in P.MODEL_DATA_COLUMNS]
    if with_index:
        fields.insert(0, T.StructField(P.CSV_INDEX_COLUMN, T.LongType()))
    return T.StructType(fields)


def write_feature_csv(df: DataFrame, path: str, compression: str | None = None) -> str:
    """CSV with a header line. NULL is written as ``NULL_MARK``, an empty string as an empty quoted field."""
    df.write.mode("overwrite").options(**CSV_OPTIONS, emptyValue='""').csv(path, compression=compression)
    return path


def read_feature_csv(spark: SparkSession, path: str, with_index: bool = False, null_value: str = NULL_MARK) -> DataFrame:
    """Read an exported feature frame with the declared schema (no inference:
    codes keep their leading zeros). A leading unnamed index column, as
    written by pandas, is read and dropped; pandas writes NULL as an empty
    field, so pass ``null_value=""`` for its files."""
    schema = model_data_schema(with_index)
    df = (spark.read.schema(schema).options(**{**CSV_OPTIONS, "nullValue": null_value, "emptyValue": ""})
          .option("mode", "FAILFAST").option("enforceSchema", True).option("multiLine", True).csv(path))
    return df.drop(P.CSV_INDEX_COLUMN) if with_index else df
