"""Date-time differences with explicit semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def year_boundaries(ts, year) -> Column:
    """Number of year boundaries from 1 January of ``year`` to ``ts``.

    This is the year-part difference (2150-01-01 vs 2149 gives 1, and a
    date in 2149 gives 0), not the number of whole elapsed years.
    """
    return F.year(_c(ts)) - _c(year)


def elapsed_days(end, start) -> Column:
    """Whole 24-hour periods from ``start`` to ``end`` (truncated toward zero)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def calendar_days(end, start) -> Column:
    """Midnights crossed from ``start`` to ``end`` (0 on the same day)."""
    return F.datediff(_c(end), _c(start))


DAY_UNITS = {"elapsed": elapsed_days, "calendar": calendar_days}
