"""Small fixed tables (rule tables, model summaries) as JVM-side local relations.

``spark.createDataFrame(list)`` goes through a Python RDD, so every use would
start Python workers; a VALUES list is planned as a local relation instead.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if abs(v) > 2**31 - 1 else str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "double('NaN')"
        if math.isinf(v):
            return "double('Infinity')" if v > 0 else "double('-Infinity')"
        return f"CAST({v!r} AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """DataFrame from a short list of tuples; ``schema`` is a DDL string
    ('a int, b string'). Columns are cast to the declared types."""
    cols = [c.strip().split(None, 1) for c in schema.split(",")]
    names = [c[0] for c in cols]
    if not rows:
        return spark.createDataFrame([], schema)
    values = ",\n".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in cols)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(f'`{n}`' for n in names)})")
