"""Model fits from sufficient statistics: what a step needs is a few sums over all rows, one aggregate.

The sums are combined map-side; their number depends on the features alone, and
they are what reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.sources.local import local_frame

INTERCEPT = "(intercept)"


def newton_logistic(df: DataFrame, columns: list[str], label: str, steps: int = 5, C: float = 1.0) -> DataFrame:
    """(step, term, coefficient) of L2 logistic regression after 1 to ``steps`` Newton steps from zero.

    The loss is the summed logistic loss plus |w|^2 / (2 C), the intercept free: ``models.logistic_regression``'s, at
    whose fit the steps arrive. A step's gradient and Hessian are one aggregate.
    """
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    pairs = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    penalty = np.diag([0.0, *[1.0 / C] * len(columns)])
    w, rows = np.zeros(len(x)), []
    for step in range(1, steps + 1):
        z = sum((F.lit(float(v)) * c for v, c in zip(w[1:], x[1:])), F.lit(float(w[0])))
        p = 1 / (1 + F.exp(-z))
        scored = df.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], p.alias("p"), F.col(label).cast("double").alias("y"))
        row = scored.agg(*[F.sum((F.col("p") - F.col("y")) * F.col(f"x{i}")).alias(f"g{i}") for i in range(len(x))],
                         *[F.sum(F.col("p") * (1 - F.col("p")) * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in pairs]).first()
        if row["g0"] is None:  # no rows
            return local_frame(df.sparkSession, [], "step int, term string, coefficient double")
        hessian = penalty.copy()
        for i, j in pairs:
            hessian[i, j] += row[f"h{i}_{j}"]
            hessian[j, i] = hessian[i, j]
        gradient = np.array([row[f"g{i}"] for i in range(len(x))]) + penalty @ w
        w = w - np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        rows += [(step, term, float(v)) for term, v in zip([INTERCEPT, *columns], w)]
    return local_frame(df.sparkSession, rows, "step int, term string, coefficient double")


def principal_shares(covariances: DataFrame, k: int = 5, sweeps: int = 30) -> DataFrame:
    """(component, share): the parts of the variance along the first ``k`` principal components, from covariances
    (``feature_a, feature_b, covariance``, one row for each pair): a matrix as large as the features squared."""
    rows = covariances.collect()
    names = sorted({r["feature_a"] for r in rows} | {r["feature_b"] for r in rows})
    at = {n: i for i, n in enumerate(names)}
    matrix = np.zeros((len(names), len(names)))
    for r in rows:
        matrix[at[r["feature_a"]], at[r["feature_b"]]] = matrix[at[r["feature_b"]], at[r["feature_a"]]] = r["covariance"]
    values = sorted(jacobi(matrix, sweeps), reverse=True)
    total = sum(values)
    shares = [(i + 1, float(v / total) if total else 0.0) for i, v in enumerate(values[:k])]
    return local_frame(covariances.sparkSession, shares, "component int, share double")


def jacobi(matrix: np.ndarray, sweeps: int = 30) -> list[float]:
    """Eigenvalues of a symmetric matrix: rotations that make one pair of entries after the other zero, until all are."""
    m = matrix.astype(float).copy()
    for _ in range(sweeps):
        off = np.abs(m - np.diag(np.diag(m)))
        if not off.size or off.max() <= 1e-15 * max(np.abs(np.diag(m)).max(), 1e-300):
            break
        for i in range(len(m)):
            for j in range(i + 1, len(m)):
                if m[i, j] == 0.0:
                    continue
                angle = 0.5 * np.arctan2(2 * m[i, j], m[i, i] - m[j, j])
                c, s = np.cos(angle), np.sin(angle)
                rows = m[[i, j]].copy()
                m[i], m[j] = c * rows[0] + s * rows[1], c * rows[1] - s * rows[0]
                columns = m[:, [i, j]].copy()
                m[:, i], m[:, j] = c * columns[:, 0] + s * columns[:, 1], c * columns[:, 1] - s * columns[:, 0]
    return np.diag(m).tolist()
