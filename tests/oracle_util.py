"""Compare a Spark DataFrame with DuckDB SQL over the same test tables."""

import math

import duckdb
import pandas as pd

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(round(v, 9))
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return pd.Timestamp(v).isoformat()
    return str(v)


def normalised(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted("|".join(_cell(v) for v in row) for row in pdf[cols].itertuples(index=False))


def same(spark_df, con, sql):
    a = normalised(spark_df.toPandas())
    b = normalised(con.execute(sql).df())
    return a == b, a, b
