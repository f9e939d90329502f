"""Groups compared in full, in blocks.

The rows of a group are dealt into slots of about ``block`` rows, and each pair
of slots is a task of its own, however large the group. Groups of one slot share
tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored

BROADCAST_GROUPS = 200_000


def compared(members: DataFrame, payload: DataFrame, group: str, row: str, block: int, schema: str,
             compare: Callable[[pd.DataFrame, pd.DataFrame | None], Iterator[pd.DataFrame]]) -> DataFrame:
    """Run ``compare(left, right)`` on every pair of slots of every group (``right`` None: a slot with itself).

    ``members`` has a narrow row per member, ``payload`` (by ``row``) what the comparison reads; the members are
    dealt out first. Only groups of more than one slot need a look-up of their size, at most one for each ``block`` rows;
    up to ``BROADCAST_GROUPS`` of them are sent to all executors, so that a large group's members stay where they are.
    """
    sizes = members.groupBy(group).agg(F.count("*").alias("_size")).filter(F.col("_size") > block)
    sizes = stored(sizes, "block-sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_GROUPS else sizes
    slots = F.coalesce(F.ceil(F.col("_size") / block), F.lit(1))
    shares = max(1, -(-members.count() // block))
    dealt = members.join(sizes, group, "left").withColumns({"_slots": slots, "_slot": F.pmod(F.xxhash64(row), slots)})
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1)))
    dealt = dealt.withColumns({
        "_lo": F.least("_slot", "_other"), "_hi": F.greatest("_slot", "_other"),
        "_whole": F.when(F.col("_slots") > 1, F.col(group)),
        "_share": F.when(F.col("_slots") == 1, F.pmod(F.xxhash64(group), F.lit(shares)))}).join(payload, row)

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby(group, sort=False):
            part = part.sort_values(row, kind="stable")
            lo, hi = part["_lo"].iloc[0], part["_hi"].iloc[0]
            if lo == hi:
                out += compare(part, None)
            else:
                left, right = part[part["_slot"] == lo], part[part["_slot"] == hi]
                if len(left) and len(right):
                    out += compare(left, right)
        empty = pd.DataFrame({part.split()[0]: pd.Series(dtype="int64") for part in schema.split(", ")})
        return pd.concat([empty, *out]) if out else empty

    kept = [c for c in dealt.columns if c not in ("_size", "_slots", "_other")]
    return dealt.select(*kept).groupBy("_whole", "_share", "_lo", "_hi").applyInPandas(lambda rows: task(rows), schema)
