"""Permutation importance: how much worse a fixed model scores when one column is dealt to other rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.operators.ordering import numbered
from wardflow.sources.local import local_frame


def permutation_importance(df: DataFrame, id_col: str, label: str, columns: list[str], predict: Callable[[dict[str, Column]], Column],
                           seed: int = 42, digits: int = 9) -> DataFrame:
    """(feature, accuracy, permuted_accuracy, importance): accuracy of ``predict`` (from a column for each feature to a
    prediction) with the rows' own values, and with those of one feature moved on by one row in seeded order (by
    md5('<seed>:<id>'), then id), the last row's to the first.

    Rows get their numbers from range partitions, so no task sees them all, and one join gives each row the one before
    it; every feature's permutation is then a projection, and all accuracies are one aggregate.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    narrow = df.select(F.col(id_col).alias("_id"), F.col(label).alias("_y"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(columns)], key.alias("_h"))
    rows = numbered(narrow, [F.col("_h"), F.col("_id")], "_nth", "permutation")
    n = rows.count()
    moved = rows.select((F.col("_nth") % n + 1).alias("_nth"), *[F.col(f"x{i}").alias(f"m{i}") for i in range(len(columns))])
    pairs = rows.join(moved, "_nth")
    own = {c: F.col(f"x{i}") for i, c in enumerate(columns)}
    right = lambda values: F.sum(F.when(predict(values) == F.col("_y"), 1).otherwise(0))
    row = pairs.agg(right(own).alias("own"), *[right({**own, c: F.col(f"m{i}")}).alias(f"r{i}") for i, c in enumerate(columns)]).first()
    counts = [(c, row["own"], row[f"r{i}"], n) for i, c in enumerate(columns)] if n else []
    found = local_frame(df.sparkSession, counts, "feature string, own long, moved long, n long")
    return found.select("feature", F.round(F.col("own") / F.col("n"), digits).alias("accuracy"),
                        F.round(F.col("moved") / F.col("n"), digits).alias("permuted_accuracy"),
                        F.round((F.col("own") - F.col("moved")) / F.col("n"), digits).alias("importance"))
