"""Places and running sums in a total order, without a window over everything or over one hot key.

Rows are cut into ranges of the order and written with their range's number, so
ranges are fixed from then on. Inside a range a window does the work; what the
ranges before it add (a few sums per range, or per range and first or last key)
is a table of some rows a range, joined back. A key with any share of the rows is
spread over as many ranges as its rows fill, provided that the order goes on
below the key (a time, a tie-break).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.session import shared_dir

RANGE = "_range"


def in_ranges(rows: DataFrame, order: list[Column], name: str = "ranges") -> DataFrame:
    """``rows`` written in ranges of ``order`` and read back with ``_range``, ascending in that order. Rows that are equal in
    the order are in the same range."""
    spark = rows.sparkSession
    path = shared_dir(spark, name)
    spread = rows.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id())
    spread.write.parquet(path)
    return spark.read.schema(spread.schema).parquet(path)


def numbered(rows: DataFrame, order: list[Column], number: str = "number", name: str = "ranges") -> DataFrame:
    """``rows`` with their place in ``order``, from 1. The order of rows that are equal in it isn't defined."""
    parts = in_ranges(rows, order, name)
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # over a row per range
    sizes = parts.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    out = parts.withColumn(number, local).join(F.broadcast(sizes), RANGE)  # a row per range
    return out.withColumn(number, F.col("_before") + F.col(number)).drop(RANGE, "_before")
