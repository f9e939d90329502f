"""Data preparation on Spark: imputation, one-hot columns, exact balanced
sampling with its complement, stratified folds, frame profile, class shares."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.ordering import numbered

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def impute(df: DataFrame, numeric_value=0, categorical_value: str = "UNKNOWN", exclude=()) -> DataFrame:
    """NULL -> 0 in numeric columns and -> 'UNKNOWN' in string columns."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    return df.na.fill(numeric_value, subset=num).na.fill(categorical_value, subset=cat)


def category_values(df: DataFrame, column: str) -> list:
    """Sorted distinct non-NULL values of a categorical column (see ``categories_of``)."""
    return categories_of(df, [column])[column]


def categories_of(df: DataFrame, columns) -> dict[str, list]:
    """Sorted distinct non-NULL values of several categorical columns in one
    job: (column, value) pairs are made distinct by Spark. The values become
    columns of a frame, so they are few by nature; where they aren't, use
    ``one_hot_vector``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in columns]))
    rows = df.select(pairs.alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull()).distinct().collect()
    out: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        out[r["c"]].append(r["v"])
    return {c: sorted(vals) for c, vals in out.items()}


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the distinct non-NULL values of a categorical column, numbered from 0 in sorted order. Distributed:
    for any number of values."""
    values = df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    return numbered(values, [F.col("value")], "code", "categories").select("value", (F.col("code") - 1).alias("code"))


def one_hot_vector(df: DataFrame, column: str, output: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``column`` replaced by a sparse 0/1 vector ``output`` (default ``<column>_vec``), one slot per value in
    sorted order (or as in ``codes``, say of the training data); a NULL and a value without a code are all zeros. For any
    number of values: the frame stays one column wide, and only their number reaches the driver."""
    output = output or f"{column}_vec"
    codes = category_codes(df, column) if codes is None else codes
    n = codes.count()
    coded = df.join(codes.select(F.col("value").alias("_value"), F.col("code").alias("_code")),
                    F.col(column).cast("string") == F.col("_value"), "left")
    # The last of n + 1 declared values, which dropLast leaves without a slot, stands for no value.
    slot = F.coalesce(F.col("_code"), F.lit(n)).cast("double")
    coded = coded.withColumn("_slot", slot.alias("_slot", metadata={"ml_attr": {"type": "nominal", "num_vals": n + 1}}))
    if not n:
        return coded.withColumn(output, array_to_vector(F.array().cast("array<double>"))).drop("_slot", "_value", "_code", column)
    out = OneHotEncoder(inputCol="_slot", outputCol=output, dropLast=True).fit(coded).transform(coded)
    return out.drop("_slot", "_value", "_code", column)


def one_hot(df: DataFrame, column: str, values: list | None = None, prefix: str | None = None) -> DataFrame:
    """Replace ``column`` by one 0/1 int column per value, named
    ``<prefix>_<value>`` in sorted value order and appended at the end; a NULL
    is all zeros. ``values`` may be given (e.g. taken from the training data)
    so that other frames get the same columns."""
    values = category_values(df, column) if values is None else values
    prefix = column if prefix is None else prefix
    src = F.col(column)
    rest = [F.col(c) for c in df.columns if c != column]
    dummies = [F.when(src == v, 1).otherwise(0).alias(f"{prefix}_{v}") for v in values]
    return df.select(*rest, *dummies)


def _rank_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _buckets(df: DataFrame, label: str, id_col: str, seed: int, digits: int, classes) -> DataFrame:
    """id, label, seeded hash ``_h`` and its bucket ``_b``: the narrow rows that are counted and ranked."""
    rows = df.where(F.col(label).isin(*classes)).select(id_col, label, _rank_key(id_col, seed).alias("_h"))
    return rows.withColumn("_b", F.substring("_h", 1, digits))


def _offsets(rows: DataFrame, label: str, classes) -> DataFrame:
    """Per (class, bucket): its rows ``_c``, the rows of the class before it ``_off``, and the smaller class's size ``_n``.
    At most len(classes) * 16^digits rows, a bound set by the parameters: one small window, and safe to broadcast."""
    counts = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_c"))
    by_bucket = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = [F.sum(F.when(F.col(label) == k, F.col("_c")).otherwise(0)).over(Window.partitionBy()) for k in classes]
    return counts.select(label, "_b", "_c", F.coalesce(F.sum("_c").over(by_bucket), F.lit(0)).alias("_off"),
                         F.least(*sizes).alias("_n"))


def class_rank(df: DataFrame, label: str, id_col: str, seed: int = 42, bucket_digits: int = 4,
               classes=(0, 1)) -> DataFrame:
    """(id, label, ``_rank``): the 1-based position of each row inside its class in the
    order of md5('<seed>:<id>') (then id), i.e. a seeded shuffle.

    Exact and spread out: rows are cut into 16^bucket_digits hash buckets per
    class; the buckets' offsets come from their counts, and the rank inside a
    bucket is a window over that bucket only. Only ids, labels and hashes move.
    """
    rows = _buckets(df, label, id_col, seed, bucket_digits, classes)
    in_bucket = Window.partitionBy(label, "_b").orderBy("_h", id_col)
    ranked = rows.withColumn("_local", F.row_number().over(in_bucket))
    out = ranked.join(F.broadcast(_offsets(rows, label, classes)), [label, "_b"])
    return out.select(id_col, label, (F.col("_off") + F.col("_local")).alias("_rank"))


def balanced_split(df: DataFrame, label: str, id_col: str, seed: int = 42,
                   split_col: str = "split", bucket_digits: int = 4, classes=(0, 1)) -> DataFrame:
    """``df`` with ``split_col`` = 'train' for floor(min(n0, n1) / 2) rows of **each**
    class (the first in seeded shuffle order) and 'test' for all other rows of the two
    classes. This is under-sampling of both classes; the test part keeps the
    rest of the data, so its class shares differ from the full frame.

    The last training row of each class is found from the bucket counts and a
    ranking of the one bucket that the cut falls into; every row is then
    compared with it, so the frame itself isn't shuffled.
    """
    rows = _buckets(df, label, id_col, seed, bucket_digits, classes)
    take = F.floor(F.col("_n") / 2)
    at = _offsets(rows, label, classes).where((F.col("_off") < take) & (take <= F.col("_off") + F.col("_c")))
    at = at.select(label, "_b", (take - F.col("_off")).alias("_last"))  # a row per class
    in_bucket = Window.partitionBy(label, "_b").orderBy("_h", id_col)
    cut = rows.join(F.broadcast(at), [label, "_b"]).withColumn("_local", F.row_number().over(in_bucket))
    cut = cut.where(F.col("_local") == F.col("_last")).select(label, F.col("_h").alias("_ch"), F.col(id_col).alias("_cid"))
    h = _rank_key(id_col, seed)
    train = (h < F.col("_ch")) | ((h == F.col("_ch")) & (F.col(id_col) <= F.col("_cid")))
    out = df.where(F.col(label).isin(*classes)).join(F.broadcast(cut), label, "left")
    return out.select(*df.columns, F.when(train, "train").otherwise("test").alias(split_col))


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 3, seed: int = 42,
                     fold_col: str = "fold", bucket_digits: int = 4) -> DataFrame:
    """``df`` with fold 0..k-1 by seeded shuffle order inside each class, round robin, so
    per class the fold sizes differ by at most one."""
    r = class_rank(df, label, id_col, seed, bucket_digits)
    folds = r.select(id_col, ((F.col("_rank") - 1) % k).cast("int").alias(fold_col))
    return df.join(folds, id_col).select(*df.columns, fold_col)


def group_split(df: DataFrame, group: str, test_share: float = 0.2, seed: int = 42, split_col: str = "split") -> DataFrame:
    """``df`` with 'train' / 'test' by a seeded hash of ``group``: all rows of a group fall on the same side, a NULL
    group's on the training side. A projection, no shuffle."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string"))), 1, 8), 16, 10).cast("double")
    return df.withColumn(split_col, F.when(draw / 2.0 ** 32 < test_share, "test").otherwise("train"))


def profile(df: DataFrame) -> DataFrame:
    """Per column: position, name, Spark type, non-NULL count, and the row count
    -- one aggregate pass, reshaped with ``stack``."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pieces = ", ".join(
        f"{i}, '{c.replace(chr(39), chr(39) * 2)}', '{types[c]}', _c{i}" for i, c in enumerate(cols))
    stacked = counts.select(
        F.col("_rows").alias("row_count"),
        F.expr(f"stack({len(cols)}, {pieces}) AS (position, column_name, data_type, non_null_count)"))
    return stacked.select("position", "column_name", "data_type", "non_null_count", "row_count")


def class_shares(df: DataFrame, label: str, frame: str | None = None) -> DataFrame:
    """value_counts() and value_counts(normalize=True) of the label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    out = counts.select(label, "n", (F.col("n") / total).alias("share"))
    if frame is not None:
        out = out.select(F.lit(frame).alias("frame"), *out.columns)
    return out
