"""Tree splits from histograms: rows are reduced to sums per feature and bin, and splits are found among those.

Bins are ``bins`` parts of equal width between a feature's least and greatest
value. The sums of a histogram are combined map-side, so what is shuffled is a
row per task, feature and bin, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.sources.local import local_frame


def bounds(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """The least and the greatest value of each feature (of those with two different ones)."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(features) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    found = {c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(features)}
    return {c: (lo, hi) for c, (lo, hi) in found.items() if lo is not None and lo < hi}


def bin_of(feature: str, lo: float, hi: float, bins: int) -> Column:
    """0 to ``bins`` - 1; a NULL is in the first one."""
    x = F.coalesce(F.col(feature).cast("double"), F.lit(lo))
    return F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")


def histograms(df: DataFrame, limits: dict[str, tuple[float, float]], sums: dict[str, Column], bins: int) -> DataFrame:
    """(position, feature, bin, <sums>): sums of the rows of each bin of each feature."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), bin_of(c, lo, hi, bins).alias("bin"))
                                for i, (c, (lo, hi)) in enumerate(limits.items())]))
    rows = df.select(*[v.alias(n) for n, v in sums.items()], cells.alias("c")).select(*sums, "c.*")
    return rows.groupBy("position", "feature", "bin").agg(*[F.sum(n).alias(n) for n in sums])


def _sides(hist: DataFrame, sums: list[str]) -> DataFrame:
    """For a split after each bin: the sums left of it and of all; the last bin has no split. A row per feature and bin."""
    inside = Window.partitionBy("position").orderBy("bin")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("position")
    out = hist.withColumns({**{f"{c}_left": F.sum(c).over(upto) for c in sums}, **{f"{c}_all": F.sum(c).over(whole) for c in sums},
                            "_more": F.lead(F.lit(True)).over(inside)})
    return out.where(F.col("_more"))


def _threshold(limits: dict[str, tuple[float, float]], bins: int) -> Column:
    """The upper end of a row's bin of a row's feature."""
    out = F.lit(None).cast("double")
    for i, (lo, hi) in enumerate(limits.values()):
        out = F.when(F.col("position") == i, F.lit(lo) + (F.col("bin") + 1) * F.lit(hi - lo) / bins).otherwise(out)
    return out


def best_splits(df: DataFrame, features: list[str], label: str, bins: int = 32, digits: int = 9) -> DataFrame:
    """(feature, threshold, gain, n_left, positives_left, n_right, positives_right): each feature's split of the greatest
    decrease of Gini impurity (rounded; of equal ones the lowest), rows below the threshold going left. A feature of one
    value has none."""
    limits = bounds(df, features)
    if not limits:
        return local_frame(df.sparkSession, [], "feature string, threshold double, gain double, n_left long, positives_left long, "
                                                "n_right long, positives_right long")
    hist = histograms(df, limits, {"n": F.lit(1), "y": F.col(label).cast("long")}, bins)
    sides = _sides(hist, ["n", "y"])
    impurity = lambda y, n: 2.0 * (y / n) * (1 - y / n)
    n, y, m, z = (F.col(c) for c in ("n_left", "y_left", "n_all", "y_all"))
    gain = impurity(z, m) - (n / m) * impurity(y, n) - ((m - n) / m) * impurity(z - y, m - n)
    scored = sides.withColumn("gain", F.round(gain, digits))
    best = scored.withColumn("_nth", F.row_number().over(Window.partitionBy("position").orderBy(F.col("gain").desc(), "bin"))).where("_nth = 1")
    return best.select("feature", _threshold(limits, bins).alias("threshold"), "gain", n.alias("n_left"), y.alias("positives_left"),
                       (m - n).alias("n_right"), (z - y).alias("positives_right"))


def boosted_stumps(df: DataFrame, features: list[str], label: str, rounds: int = 5, rate: float = 0.3, penalty: float = 1.0,
                   bins: int = 32, digits: int = 9) -> DataFrame:
    """(round, feature, threshold, gain, below, above): stumps fitted one after the other to the logistic loss.

    A round sums first and second derivatives of the loss per feature and bin, takes the split of the greatest gain
    (rounded; of equal ones the first feature's lowest) and gives its sides the Newton step -G / (H + penalty), times
    ``rate``. One aggregate a round; a round's stump (one row) reaches the driver and is part of the next margins.
    """
    limits = bounds(df, features)
    margin, stumps = F.lit(0.0), []
    for k in range(1, rounds + 1 if limits else 1):
        p = 1 / (1 + F.exp(-F.col("_m")))
        scored = df.withColumn("_m", margin)
        hist = histograms(scored, limits, {"g": p - F.col(label).cast("double"), "h": p * (1 - p)}, bins)
        sides = _sides(hist, ["g", "h"])
        g, h, a, b = (F.col(c) for c in ("g_left", "h_left", "g_all", "h_all"))
        gain = g * g / (h + penalty) + (a - g) * (a - g) / (b - h + penalty) - a * a / (b + penalty)
        best = (sides.withColumn("gain", F.round(gain, digits)).orderBy(F.col("gain").desc(), "position", "bin").limit(1)
                .select("feature", "bin", _threshold(limits, bins).alias("threshold"), "gain",
                        (-rate * g / (h + penalty)).alias("below"), (-rate * (a - g) / (b - h + penalty)).alias("above")).first())
        if best is None:
            break
        stumps.append((k, best["feature"], best["threshold"], best["gain"], best["below"], best["above"]))
        lo, hi = limits[best["feature"]]
        margin = margin + F.when(bin_of(best["feature"], lo, hi, bins) <= best["bin"], F.lit(best["below"])).otherwise(F.lit(best["above"]))
    return local_frame(df.sparkSession, stumps, "round int, feature string, threshold double, gain double, below double, above double")
