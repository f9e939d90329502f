"""Prefix scans per segment (entity), for segments of any size.

Rows are sorted into ranges of (segment, time, tie) and written. A window inside
(range, segment) gives each row its number, the next row's time and the sums of
strictly earlier rows as far as its range knows; what earlier ranges add is
worked out from totals. Only the first and the last segment of a range can go
on in another one, so the totals are at most two rows a range: they go to every
task. One segment, one day of it or even one moment of it may hold any share
of the rows: it is as many ranges as its rows fill, and no window is larger than
a range.

Strictly earlier means an earlier time: rows of equal time don't count for one
another, also if a range ends between them. For that, the totals hold each
segment's last time in the range and the sums at that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.operators.ordering import RANGE, in_ranges


def _key(segment: str) -> Column:
    """The segment so that NULL is a value like others and comes first."""
    return F.struct(F.col(segment).isNotNull().alias("known"), F.col(segment).alias("value"))


def _totals(parts: DataFrame, segment: str, time: str, sums: list[str]) -> DataFrame:
    """Per range and segment that can go on in another range: what the earlier ranges hold, and the next one's first time."""
    ends = parts.groupBy(RANGE).agg(F.min(_key(segment)).alias("_lo"), F.max(_key(segment)).alias("_hi"))
    rows = parts.join(F.broadcast(ends), RANGE)  # a row per range
    rows = rows.where((_key(segment) == F.col("_lo")) | (_key(segment) == F.col("_hi")))
    # Sums of each time first, so that a hot segment is many groups; then of the segment, and at its last time.
    moments = rows.groupBy(RANGE, segment, time).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sums])
    place = F.struct(F.col(time).isNotNull(), F.col(time))
    edges = moments.groupBy(RANGE, segment).agg(
        F.sum("_n").alias("_n"), *[F.sum(c).alias(c) for c in sums], F.max(time).alias("_last"),
        F.when(F.count(time) == F.count(F.lit(1)), F.min(time)).alias("_first"),
        *[F.max_by(c, place).alias(f"{c}_at_last") for c in sums])
    in_order = Window.partitionBy(segment).orderBy(RANGE)  # at most a row per range
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    same_last = Window.partitionBy(segment, "_last").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = edges.withColumns({f"{c}_tied": F.sum(f"{c}_at_last").over(same_last) for c in sums})
    zero = F.lit(0).cast("long")
    return edges.select(
        F.col(RANGE).alias("_r"), F.col(segment).alias("_s"), F.lead("_first").over(in_order).alias("_next"),
        F.lag("_last").over(in_order).alias("_tie_time"), F.coalesce(F.sum("_n").over(earlier), zero).alias("_before"),
        *[F.coalesce(F.sum(c).over(earlier), zero).alias(f"{c}_before") for c in sums],
        *[F.coalesce(F.lag(f"{c}_tied").over(in_order), zero).alias(f"{c}_tied") for c in sums])


def segment_scan(rows: DataFrame, segment: str, time: str, tie: list[str], sums: list[str] = (),
                 ordinal: str = "ordinal", next_time: str = "next_time") -> DataFrame:
    """``rows`` with their number in the segment by (time, tie), the time of the next row in it, and for each column of
    ``sums`` (whole numbers) its sum over the rows of the segment with an earlier time, under the column's own name.

    NULL times come first, and NULL segments are one segment. A row of NULL time has no earlier rows and is none.
    """
    keep = [c for c in rows.columns if c not in sums]
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({c: F.when(F.col(time).isNotNull(), F.coalesce(F.col(c), F.lit(0))).otherwise(0).cast("long") for c in sums})
    order = [F.col(time).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie]]
    parts = in_ranges(rows, [F.col(segment).asc_nulls_first(), *order], "segments")
    totals = _totals(parts, segment, time, sums)

    by_row = Window.partitionBy(RANGE, segment).orderBy(*order)
    by_time = Window.partitionBy(RANGE, segment).orderBy(F.col(time).asc_nulls_first())
    upto = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.select(
        *keep, RANGE, F.row_number().over(by_row).alias("_rn"), F.lead(time).over(by_row).alias("_lead"),
        F.lead(F.lit(True)).over(by_row).alias("_more"),
        *[(F.sum(c).over(upto) - F.sum(c).over(Window.partitionBy(RANGE, segment, time))).alias(f"_in_{i}") for i, c in enumerate(sums)])
    out = local.join(F.broadcast(totals), (F.col(RANGE) == F.col("_r")) & F.col(segment).eqNullSafe(F.col("_s")), "left")
    tied = F.col(time) == F.col("_tie_time")
    before = [F.when(F.col(time).isNull(), zero).otherwise(
        F.col(f"_in_{i}") + F.coalesce(F.col(f"{c}_before"), zero) - F.when(tied, F.col(f"{c}_tied")).otherwise(zero)).alias(c)
        for i, c in enumerate(sums)]
    return out.select(*keep, (F.col("_rn") + F.coalesce("_before", zero)).alias(ordinal),
                      F.when(F.col("_more"), F.col("_lead")).otherwise(F.col("_next")).alias(next_time), *before)
