"""Co-occurrence of codes within a window of a sequence, and positive pointwise mutual information."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skip_grams(seqs: DataFrame, seq_col: str, window: int = 2, sep: str = " ") -> DataFrame:
    """(code_a, code_b, n): how often b stands at most ``window`` places before or after a.

    Pairs come from a sequence's array laid against itself, moved by 1 to ``window`` places, so sequences are neither
    shuffled nor joined with themselves; counts are combined map-side, so a frequent pair is one row per task.
    """
    tokens = seqs.select(F.split(F.col(seq_col), sep).alias("t")).where(F.size("t") > 1)
    moved = lambda k: F.expr(
        f"if(size(t) > {k}, zip_with(slice(t, 1, size(t) - {k}), slice(t, {k} + 1, size(t) - {k}), (a, b) -> struct(a, b)), "
        "cast(array() as array<struct<a: string, b: string>>))")
    pairs = tokens.select(F.explode(F.concat(*[moved(k) for k in range(1, window + 1)])).alias("p")).select("p.a", "p.b")
    one = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    both = one.union(one.select("b", "a", "n"))
    return both.groupBy(F.col("a").alias("code_a"), F.col("b").alias("code_b")).agg(F.sum("n").alias("n"))


def ppmi(pairs: DataFrame, digits: int = 9) -> DataFrame:
    """``pairs`` (``code_a, code_b, n``, both directions) with ``ppmi`` = max(0, ln(n N / (n_a n_b))), where n_a sums a's pairs
    and N all of them."""
    own = pairs.groupBy("code_a").agg(F.sum("n").alias("n_a"))  # a row per code
    other = own.select(F.col("code_a").alias("code_b"), F.col("n_a").alias("n_b"))
    total = float(own.agg(F.sum("n_a")).first()[0] or 0)
    rows = pairs.join(own, "code_a").join(other, "code_b")
    d = lambda c: F.col(c).cast("double")
    value = F.greatest(F.lit(0.0), F.log(d("n") * F.lit(total) / (d("n_a") * d("n_b"))))
    return rows.select("code_a", "code_b", "n", F.round(value, digits).alias("ppmi"))
