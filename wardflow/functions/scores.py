"""Banded and weighted scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def score_bands(value, cuts) -> Column:
    """0 if value <= cuts[0], 1 if <= cuts[1], ..., len(cuts) otherwise.

    NULL falls through every comparison and gets the top band, as a searched
    CASE with ELSE does.
    """
    value = F.col(value) if isinstance(value, str) else value
    expr = None
    for band, cut in enumerate(cuts):
        expr = F.when(value <= cut, band) if expr is None else expr.when(value <= cut, band)
    return expr.otherwise(len(cuts))


def weighted_index(base, weights: dict, dominance) -> Column:
    """base + sum(weight * flag) + sum(greatest(w1 * f1, w2 * f2)) over pairs.

    Flags are expected non-NULL (0/1); a NULL base makes the index NULL.
    """
    base = F.col(base) if isinstance(base, str) else base
    total = base
    for name, w in weights.items():
        total = total + (F.col(name) if w == 1 else F.lit(w) * F.col(name))
    for (a, wa), (b, wb) in dominance:
        total = total + F.greatest(F.lit(wa) * F.col(a), F.lit(wb) * F.col(b))
    return total
