"""Per-entity ordered operators: age at event, episode ordinal, next start,
return-within-N-days, and strictly-earlier history counts.

Ordered work is done in one of two ways, with equal results. With ``ranges`` rows
are sorted into written ranges of (entity, time, tie) and scanned by
``segments.segment_scan``: no group is too large, and a run that stores its result
anyway should take it. Without, a plan stays lazy, and work is partitioned by
(entity, day) instead of by entity alone, so that one entity holding a large
share of all rows is spread over as many tasks as it has days:

* level 1 (per day): a window over the rows of one (entity, day) group gives
  the row number, the next start inside the day and the weights seen strictly
  earlier inside the day;
* level 2 (per entity): the rows are pre-aggregated to one row per (entity,
  day) (partial aggregation before the shuffle); a window over these small
  rows gives the counts and weights of all earlier days and the first start of
  the next day. One entity contributes at most one row per calendar day here,
  a bound set by the time span, not by the data volume;
* the two levels are joined back on (entity, day).

NULL start times sort first (as ASC does) and go to a sentinel first bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.dates import DAY_UNITS, year_boundaries
from wardflow.operators.segments import segment_scan

_FIRST_DAY = "0001-01-01"


def _day_of(col: Column) -> Column:
    return F.coalesce(F.to_date(col), F.lit(_FIRST_DAY).cast("date"))


def _per_day_prefix(rows: DataFrame, entity: str, sums: list[str], first_of: Column | None = None) -> DataFrame:
    """One row per (entity, day): totals of earlier days, via a small window."""
    extra = [] if first_of is None else [F.min(first_of).alias("_first")]
    per_day = rows.groupBy(entity, "_day").agg(
        F.count(F.lit(1)).alias("_n_day"), *extra, *[F.sum(c).alias(f"_s{c}") for c in sums])
    by_day = Window.partitionBy(entity).orderBy("_day")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col(entity).alias("_e"), F.col("_day").alias("_d"), "_n_day",
            F.coalesce(F.sum("_n_day").over(before), F.lit(0)).alias("_n_before")]
    cols += [F.coalesce(F.sum(f"_s{c}").over(before), F.lit(0)).alias(f"_p{c}") for c in sums]
    if first_of is not None:
        cols.append(F.lead("_first").over(by_day).alias("_next_first"))
    return per_day.select(*cols)


def episode_scan(episodes: DataFrame, entity: str, start: str, tie: str,
                 weights: dict[str, Column] | None = None, ranges: bool = False) -> DataFrame:
    """Add ``ordinal``, ``next_start`` and one strictly-earlier count per weight.

    ordinal     -- ROW_NUMBER over the entity ordered by (start, tie), first = 1
    next_start  -- LEAD(start) over the same order
    <weight>    -- number of episodes of the entity with a start strictly
                   before this one's start where the weight condition holds
                   (0 if none, or if this episode's start is NULL)
    """
    weights = weights or {}
    s = F.col(start)
    keep = episodes.columns
    if ranges:
        named = {f"_w{i}": F.when(c, 1).otherwise(0) for i, c in enumerate(weights.values())}
        out = segment_scan(episodes.withColumns(named), entity, start, [tie], list(named), next_time="next_start")
        return out.select(*keep, "ordinal", "next_start", *[
            F.when(F.col(entity).isNull(), F.lit(0).cast("long")).otherwise(F.col(c)).alias(n) for n, c in zip(weights, named)])
    base = episodes.withColumn("_day", _day_of(s))
    wnames = []
    for i, (name, cond) in enumerate(weights.items()):
        col = f"_w{i}"
        base = base.withColumn(col, F.when(s.isNotNull() & cond, 1).otherwise(0))
        wnames.append((name, col))

    days = _per_day_prefix(base, entity, [c for _, c in wnames], first_of=s)

    in_day = Window.partitionBy(entity, "_day").orderBy(s.asc_nulls_first(), F.col(tie).asc_nulls_first())
    upto = Window.partitionBy(entity, "_day").orderBy(s.asc_nulls_first()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy(entity, "_day", start)
    inner = base.select(
        *keep, "_day",
        F.row_number().over(in_day).alias("_rn"),
        F.lead(s).over(in_day).alias("_lead"),
        *[(F.sum(c).over(upto) - F.sum(c).over(peers)).alias(f"_q{c}") for _, c in wnames])

    # Rows without an entity are one entity for order (as PARTITION BY does) and have no history (as = does).
    j = inner.join(days, inner[entity].eqNullSafe(days["_e"]) & (inner["_day"] == days["_d"]), "left")
    out = [F.col(c) for c in keep]
    out.append((F.coalesce(F.col("_n_before"), F.lit(0)) + F.col("_rn")).alias("ordinal"))
    out.append(F.when(F.col("_rn") < F.col("_n_day"), F.col("_lead"))
               .otherwise(F.col("_next_first")).alias("next_start"))
    for name, c in wnames:
        out.append(F.when(s.isNull() | F.col(entity).isNull(), F.lit(0).cast("long"))
                   .otherwise(F.col(f"_p{c}") + F.col(f"_q{c}")).alias(name))
    return j.select(*out)


def prior_event_counts(episodes: DataFrame, events: DataFrame, entity: str, start: str, tie: str,
                       time: str, weights: dict[str, Column], ranges: bool = False) -> DataFrame:
    """Per episode, the number of the entity's events strictly before its start,
    one count per weight condition. Returns (entity, tie, <weights>...).

    Same result as ``episodes LEFT JOIN events ON entity = entity AND
    events.time < episodes.start`` followed by SUM(CASE ... THEN 1 ELSE 0),
    without materialising the pairs. Events are first reduced to one row per
    (entity, time), combined map-side; the window inside a day only sees days
    that hold an episode. A NULL entity matches nothing: its counts are 0.
    """
    names = list(weights)
    wcols = [f"_w{i}" for i in range(len(names))]
    if ranges:
        # Events that count for something, and the episodes, in one scan.
        ev = events.select(F.col(entity).alias("_e"), F.lit(None).cast(episodes.schema[tie].dataType).alias(tie), F.col(time).alias("_t"),
                           F.lit(0).alias("_kind"), *[F.when(c, 1).otherwise(0).cast("long").alias(w) for w, c in zip(wcols, weights.values())])
        ev = ev.where(F.col("_t").isNotNull() & F.col("_e").isNotNull() & (sum(F.col(w) for w in wcols) > 0))
        ep = episodes.select(F.col(entity).alias("_e"), F.col(tie), F.col(start).alias("_t"), F.lit(1).alias("_kind"),
                             *[F.lit(0).cast("long").alias(w) for w in wcols])
        # Equal rows are apart by a number without meaning, so that a moment of an entity can be cut anywhere.
        both = ev.unionByName(ep).withColumn("_u", F.monotonically_increasing_id())
        out = segment_scan(both, "_e", "_t", ["_kind", tie, "_u"], wcols).where(F.col("_kind") == 1)
        return out.select(F.col("_e").alias(entity), F.col(tie), *[F.col(c).alias(n) for n, c in zip(names, wcols)])
    ev = events.where(F.col(time).isNotNull() & F.col(entity).isNotNull()).groupBy(
        F.col(entity).alias("_e"), F.col(time).alias("_t")).agg(
        *[F.sum(F.when(cond, 1).otherwise(0)).alias(c) for c, cond in zip(wcols, weights.values())])
    ev = ev.withColumn("_d", _day_of(F.col("_t")))
    ep = episodes.select(F.col(entity).alias("_e"), F.col(tie), F.col(start).alias("_t"),
                         _day_of(F.col(start)).alias("_d"))

    # Level 2: all earlier days. The episodes' days are in, so each finds its own row.
    days = ev.groupBy("_e", "_d").agg(*[F.sum(c).alias(c) for c in wcols]).unionByName(
        ep.select("_e", "_d", *[F.lit(0).cast("long").alias(c) for c in wcols]).distinct())
    days = days.groupBy("_e", "_d").agg(*[F.sum(c).alias(c) for c in wcols])
    before = Window.partitionBy("_e").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_e", "_d", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_p{c}") for c in wcols])

    # Level 1: earlier times of the same day.
    held = ep.select("_e", "_d").distinct()
    same = ev.join(held, ["_e", "_d"], "left_semi").select(
        "_e", F.lit(None).cast(episodes.schema[tie].dataType).alias(tie), "_t", "_d", F.lit(0).alias("_kind"), *wcols)
    rows = same.unionByName(ep.select("_e", tie, "_t", "_d", F.lit(1).alias("_kind"),
                                      *[F.lit(0).cast("long").alias(c) for c in wcols]))
    upto = Window.partitionBy("_e", "_d").orderBy(F.col("_t").asc_nulls_first()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy("_e", "_d", "_t")
    inner = rows.select("_e", tie, "_t", "_d", "_kind",
                        *[(F.sum(c).over(upto) - F.sum(c).over(peers)).alias(f"_q{c}") for c in wcols])
    out = inner.where(F.col("_kind") == 1).join(days, ["_e", "_d"], "left")
    none = F.col("_t").isNull() | F.col("_e").isNull()
    return out.select(F.col("_e").alias(entity), F.col(tie),
                      *[F.when(none, F.lit(0).cast("long")).otherwise(F.col(f"_p{c}") + F.col(f"_q{c}")).alias(n)
                        for n, c in zip(names, wcols)])


def age_at_event(episodes: DataFrame, entities: DataFrame, key: str, at: str,
                 base_age: str, base_year: str, keep=("subject_id", "hadm_id"), name: str = "age") -> DataFrame:
    """base_age + year boundaries between 1 January of base_year and ``at``.

    Inner join: episodes without an entity row get no row (as in the source).
    """
    ent = entities.select(key, base_age, base_year)
    j = episodes.select(*dict.fromkeys([*keep, key, at])).join(ent, key, "inner")
    return j.select(*keep, (F.col(base_age) + year_boundaries(at, base_year)).alias(name))


def episode_ordinal(episodes: DataFrame, entity: str, start: str, tie: str,
                    keep=("subject_id", "hadm_id"), name: str = "num_hospital_admissions", ranges: bool = False) -> DataFrame:
    scan = episode_scan(episodes.select(*dict.fromkeys([*keep, entity, start, tie])), entity, start, tie, ranges=ranges)
    return scan.select(*keep, F.col("ordinal").alias(name))


def returns_within(episodes: DataFrame, entity: str, start: str, end: str, tie: str,
                   days: int = 30, unit: str = "elapsed", keep=("subject_id", "hadm_id"),
                   name: str = "readmission_flag", ranges: bool = False) -> DataFrame:
    """1 if the entity's next episode (by start, then tie) starts at most ``days``
    days after this one ends, else 0 (also for the last episode).

    unit="elapsed" counts whole 24-hour periods, unit="calendar" midnights.
    Overlapping episodes give a negative gap and count as a return.
    """
    diff = DAY_UNITS[unit]
    scan = episode_scan(episodes.select(*dict.fromkeys([*keep, entity, start, end, tie])), entity, start, tie, ranges=ranges)
    flag = F.when(diff(F.col("next_start"), F.col(end)) <= days, 1).otherwise(0)
    return scan.select(*keep, end, flag.alias(name))
