"""Column-expression helpers (all built-in Spark functions, codegen-friendly)."""

from wardflow.functions.dates import calendar_days, elapsed_days, year_boundaries
from wardflow.functions.scores import score_bands, weighted_index

__all__ = [
    "calendar_days", "elapsed_days", "year_boundaries",
    "score_bands", "weighted_index",
]
