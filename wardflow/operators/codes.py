"""Code-rule flags, banded scores and weighted indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.local import local_frame


def _categories(rules) -> list[str]:
    cats: list[str] = []
    for r in rules:
        if r.category not in cats:
            cats.append(r.category)
    return cats


def rule_tables(spark: SparkSession, rules) -> dict[int, DataFrame]:
    """The value-set rules as small lookup tables, one per prefix length:
    (version, prefix) -> bit mask of the categories that list this prefix.
    Their size is fixed by the rule set (a few hundred rows), independent of
    the data, so they are always broadcast."""
    cats = _categories(rules)
    if len(cats) > 62:
        raise ValueError("at most 62 categories fit in one mask")
    bit = {c: 1 << i for i, c in enumerate(cats)}
    rows = [(r.version, r.prefix_len, v, bit[r.category]) for r in rules if r.values for v in r.values]
    df = local_frame(spark, rows, "version int, n int, prefix string, bit long")
    out = {}
    for n in sorted({r[1] for r in rows}):
        out[n] = (df.where(F.col("n") == n).groupBy("version", "prefix")
                  .agg(F.bit_or("bit").alias("mask")))
    return out


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _apart(ranges) -> list[list]:
    """The ranges in as few lists as first fit gives, no two ranges of a list overlapping."""
    lists: list[list] = []
    for r in ranges:
        home = next((held for held in lists if all(r.hi < o.lo or o.hi < r.lo for o in held)), None)
        home.append(r) if home is not None else lists.append([r])
    return lists


def range_mask(rules, code: str, version: str) -> Column:
    """Bit mask of the range rules a code matches (binary string order on the
    code prefix, no padding): per version, ranges of one prefix length that
    don't overlap are the branches of one CASE, so a code is compared with
    those of its version up to the first match. Built as one SQL expression,
    so the rule set costs one planner call, and small enough to be compiled."""
    cats = _categories(rules)
    of_version: dict[int, dict[int, list]] = {}
    for r in rules:
        if not r.values:
            of_version.setdefault(int(r.version), {}).setdefault(int(r.prefix_len), []).append(r)
    branches = []
    for v, by_length in of_version.items():
        terms = []
        for n, ranges in by_length.items():
            for held in _apart(ranges):
                whens = " ".join(f"WHEN substring({code}, 1, {n}) BETWEEN {_sql_str(r.lo)} AND {_sql_str(r.hi)} "
                                 f"THEN {1 << cats.index(r.category)}L" for r in held)
                terms.append(f"CASE {whens} ELSE 0L END")
        branches.append(f"WHEN {version} = {v} THEN {' | '.join(terms)}")
    return F.expr(f"CASE {' '.join(branches)} ELSE 0L END") if branches else F.lit(0).cast("long")


def with_code_mask(events: DataFrame, code: str, version: str, rules, how: str = "left",
                   name: str = "_mask") -> DataFrame:
    """``events`` plus the category bit mask of each row's code (``how="left"``:
    NULL where the code matches nothing; ``"inner"``: such rows dropped;
    ``"zero"``: 0 there, so that the mask is worked out once a row).

    Value sets are one hash probe per prefix length into the rule tables, whose
    size is fixed by the rule set, ranges a few comparisons: no shuffle, and
    nothing runs before the result is asked for.
    """
    rows = events.withColumns({"_v": F.col(version).cast("int"), "_c": F.col(code)})
    masks = [range_mask(rules, "_c", "_v")]
    for n, table in rule_tables(events.sparkSession, rules).items():
        t = table.select(F.col("version").alias(f"_tv{n}"), F.col("prefix").alias(f"_tp{n}"),
                         F.col("mask").alias(f"_m{n}"))
        rows = rows.join(F.broadcast(t), (F.col("_v") == F.col(f"_tv{n}"))
                         & (F.substring("_c", 1, n) == F.col(f"_tp{n}")), "left")
        masks.append(F.coalesce(F.col(f"_m{n}"), F.lit(0).cast("long")))
    mask = F.coalesce(masks[0], F.lit(0).cast("long"))
    for m in masks[1:]:
        mask = mask.bitwiseOR(m)
    if how == "zero":
        return rows.select(*events.columns, mask.alias(name))
    out = rows.select(*events.columns, F.when(mask != 0, mask).alias(name))
    return out.where(F.col(name).isNotNull()) if how == "inner" else out


def unpack_flags(df: DataFrame, key, mask: str, rules) -> DataFrame:
    """(key..., mask) -> (key..., one 0/1 int column per rule category)."""
    cats = _categories(rules)
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, *[F.shiftright(mask, i).bitwiseAND(1).cast("int").alias(c)
                            for i, c in enumerate(cats)])


def code_masks(events: DataFrame, key: str, code: str, version: str, rules) -> DataFrame:
    """(key, mask): per key, the OR of the category bits of all its codes;
    keys without any matching code get no row.

    BIT_OR is combined map-side, so each task sends at most one row per key to
    the shuffle; what matches nothing is dropped after it, since a filter on the
    mask before it would work out every row's mask again.
    """
    masks = with_code_mask(events.select(key, code, version), code, version, rules, how="zero")
    return masks.groupBy(key).agg(F.bit_or("_mask").alias("_mask")).where(F.col("_mask") != 0)


def code_flags(events: DataFrame, key: str, code: str, version: str, rules) -> DataFrame:
    """Per key, one 0/1 flag per rule category: 1 if any of the key's codes
    matches the category for its version. Keys without a matching code get
    no row (``flags_for_all`` fills in zeros)."""
    return unpack_flags(code_masks(events, key, code, version, rules), key, "_mask", rules)


def flags_for_all(episodes: DataFrame, flags: DataFrame, key: str, categories, keep) -> DataFrame:
    """Left join the flags onto every episode; episodes without codes get 0."""
    j = episodes.select(*keep).join(flags, key, "left")
    return j.select(*keep, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in categories])
