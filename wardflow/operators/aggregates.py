"""Per-key aggregate operators (one row per key, e.g. per hospital stay).

All of them are hash aggregates with a partial (map-side) phase, so a key that
holds a large share of the rows is combined inside each input task before the
shuffle. Exact distinct counts use Spark's distinct-aggregate plan, which
shuffles on (key, value) first, so a hot key is spread over tasks too.
Ordered string aggregates are built in two steps (see ``sequence_by_key``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.dates import calendar_days


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _where(events: DataFrame, where) -> DataFrame:
    return events if where is None else events.where(where)


def count_by_key(events: DataFrame, keys, col, name: str, where: Column | None = None) -> DataFrame:
    """COUNT(col) per key (NULLs not counted), after an optional filter.

    Keys with no rows left get no output row (the caller's left join turns
    them into NULL features).
    """
    return _where(events, where).groupBy(*keys).agg(F.count(_c(col)).alias(name))


def distinct_by_key(events: DataFrame, keys, col, name: str, where: Column | None = None) -> DataFrame:
    """Exact COUNT(DISTINCT col) per key; NULL is not a value."""
    return _where(events, where).groupBy(*keys).agg(F.countDistinct(_c(col)).alias(name))


def duration_totals(events: DataFrame, keys, start: str, stop: str,
                    days_name: str = "num_prescribed_days", rows_name: str = "num_prescription_records",
                    distinct_col: str | None = None, distinct_name: str | None = None) -> DataFrame:
    """Over rows with stop >= start (which drops rows with a NULL end): the sum
    of calendar-day differences and the row count, per key. Overlapping
    intervals add up; same-day ones count 0 days.

    Optionally also the exact distinct count of one column over the same rows,
    fused into the same aggregate.
    """
    rows = events.where(F.col(stop) >= F.col(start))
    aggs = [F.sum(calendar_days(stop, start)).alias(days_name), F.count(F.lit(1)).alias(rows_name)]
    if distinct_col:
        aggs.append(F.countDistinct(distinct_col).alias(distinct_name))
    return rows.groupBy(*keys).agg(*aggs)


def sequence_by_key(events: DataFrame, keys, token, order, name: str, sep: str = " ") -> DataFrame:
    """Tokens joined by ``sep`` per key, ordered by ``order`` ascending (NULLs
    first) and then by the token itself; NULL tokens are skipped and the
    result is NULL when no token is left.

    Two steps keep the work spread out: first one string per (key, order
    value), ordered by token; then one string per key from those pieces,
    ordered by order value. A key with many rows is thus split over as many
    groups as it has distinct order values, and the final step only sees one
    short row per order value. The result equals the one-step
    ``listagg(token) WITHIN GROUP (ORDER BY order, token)``.
    """
    token_c, order_c = _c(token), _c(order)
    rows = events.select(*keys, order_c.alias("_o"), token_c.alias("_tok"))
    pieces = rows.groupBy(*keys, "_o").agg(
        F.expr(f"listagg(_tok, '{sep}') WITHIN GROUP (ORDER BY _tok)").alias("_piece"))
    return pieces.groupBy(*keys).agg(
        F.expr(f"listagg(_piece, '{sep}') WITHIN GROUP (ORDER BY _o ASC NULLS FIRST)").alias(name))


def top_record(events: DataFrame, keys, payload: list[str], order_desc: list[str], name: str) -> DataFrame:
    """The payload of the row with the largest ``order_desc`` tuple per key
    (DESC, NULLs last), ties broken by the payload fields (DESC) so the pick
    is deterministic. Returns the payload as one struct column ``name``.

    ``max_by`` over a struct key keeps one running best row per key and
    merges partial results, so memory per key is constant.
    """
    tie = [c for c in payload if c not in order_desc]
    key = F.struct(*[F.col(c) for c in [*order_desc, *tie]])
    value = F.struct(*[F.col(c) for c in payload])
    return events.groupBy(*keys).agg(F.max_by(value, key).alias(name))


def sequence_profile(events: DataFrame, keys, token, order, name: str, sep: str = " ",
                     count_name: str | None = None, distinct_name: str | None = None,
                     top: tuple | None = None, pieces: bool = True) -> DataFrame:
    """``sequence_by_key`` plus, from one reduction of the same rows:

    count_name    -- COUNT(token), NULLs skipped
    distinct_name -- COUNT(DISTINCT token), exact
    top           -- (payload, order_desc, name): the row picked by ``top_record``

    ``order`` None orders by the token itself.

    Rows are first reduced to one per (key, token, order value, payload) with its
    number of occurrences (a hash aggregate, combined map-side); a window over
    (key, token) marks each token's first one, so distinct tokens are counted by a
    sum and no array of a key's tokens is ever built. These rows are joined per key:
    with ``pieces`` per order value first, which leaves the last step a row per order
    value where many tokens share one; without it, where an order value holds a token
    or few, they would be as many. Each merge equals the one-step aggregate over all
    rows of the key.
    """
    payload, order_desc, top_name = top or ([], [], None)
    named = {"_tok": _c(token)} | ({} if order is None else {"_o": _c(order)}) | {f"_p{i}": F.col(c) for i, c in enumerate(payload)}
    rows = events.select(*keys, *[c.alias(n) for n, c in named.items()]).groupBy(*keys, *named).agg(F.count(F.lit(1)).alias("_n"))
    if distinct_name:
        first = F.row_number().over(Window.partitionBy(*keys, "_tok").orderBy(*named)) == 1
        rows = rows.withColumn("_f", F.when(first & F.col("_tok").isNotNull(), 1).otherwise(0))
    # An occurrence each: the token as often as it occurs, in one piece.
    again = F.when(F.col("_n") == 1, F.col("_tok")).otherwise(F.array_join(F.array_repeat("_tok", F.col("_n").cast("int")), sep))
    sums = {"_m": count_name} if count_name else {}
    if count_name:
        rows = rows.withColumn("_m", F.when(F.col("_tok").isNotNull(), F.col("_n")).otherwise(0))
    if distinct_name:
        sums["_f"] = distinct_name
    best = []
    if top is not None:
        # All of the payload is in the order that rows are picked by, so the greatest key holds it.
        at = {c: f"_p{i}" for i, c in enumerate(payload)}
        picked = [*order_desc, *[c for c in payload if c not in order_desc]]
        rows = rows.withColumn("_best", F.struct(*[F.col(at[c]).alias(c) for c in picked]))
        best = [F.max("_best").alias("_best")]
    rows = rows.withColumn("_piece", F.when(F.col("_tok").isNotNull(), again))
    by = "_tok" if order is None else "_o ASC NULLS FIRST, _tok"
    if pieces and order is not None:
        rows = rows.groupBy(*keys, "_o").agg(F.expr(f"listagg(_piece, '{sep}') WITHIN GROUP (ORDER BY _tok)").alias("_piece"),
                                             *[F.sum(c).alias(c) for c in sums], *best)
        by = "_o ASC NULLS FIRST"
    out = rows.groupBy(*keys).agg(F.expr(f"listagg(_piece, '{sep}') WITHIN GROUP (ORDER BY {by})").alias(name),
                                  *[F.sum(c).cast("long").alias(n) for c, n in sums.items()], *best)
    if top is None:
        return out
    return out.select(*[c for c in out.columns if c != "_best"],
                      F.struct(*[F.col(f"_best.{c}").alias(c) for c in payload]).alias(top_name))
