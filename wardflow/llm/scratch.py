"""Tables written between the steps of an operator.

They go to the shared folder named by ``spark.checkpoint.dir`` (see
``wardflow.session``), so a lost executor loses nothing that was written, and
lineage ends there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.session import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, most: int = 100_000) -> DataFrame:
    """Write ``df`` under the shared folder in buckets of ``key`` (two for each of its partitions) and read it back: what
    is grouped or joined by ``key`` with it comes to its buckets, and it stays where it is. For tables of few, large rows."""
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    table = "wardflow_" + "".join(c if c.isalnum() else "_" for c in path.rsplit("/", 1)[-1])
    buckets = min(most, max(1, 2 * df.rdd.getNumPartitions()))
    df.write.bucketBy(buckets, key).option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound the Arrow batches that tasks exchange with Python by bytes: rows of text are of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
