"""Fits and importances from aggregates over the feature table, each of them checkable by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators import cooccurrence, importance, models, prep, solvers, trees
from wardflow.plans import clinical as C
from wardflow.plans.modelling import ID, LABEL, RULE_COEFFICIENTS, RULE_INTERCEPT, feature_table
from wardflow.profiles import clinical as P
from wardflow.sources import io
from wardflow.sources.tables import Tables

#: The features of the logistic regression that is fitted by Newton steps.
NEWTON_FEATURES = ["age", "charlson_comorbidity_index", "num_prev_emergency"]


def _part(t: Tables, split: str, columns) -> DataFrame:
    """The training or hold-out rows, imputed, written once: a fit reads them in every step."""
    rows = prep.balanced_split(prep.impute(feature_table(t, [ID, LABEL, *columns])), LABEL, ID)
    rows = rows.where(F.col("split") == split).drop("split")
    return io.store_and_reload(t.spark, {"rows": rows}, f"{split}-rows")["rows"]


def lr_newton(t: Tables, steps: int = 5) -> DataFrame:
    """Coefficients of a logistic regression after each of the first Newton steps."""
    out = solvers.newton_logistic(_part(t, "train", NEWTON_FEATURES), NEWTON_FEATURES, LABEL, steps)
    return out.withColumn("coefficient", F.round("coefficient", 6))


def pca_shares(t: Tables, k: int = 5) -> DataFrame:
    """Parts of the variance of the numeric features along their first principal components."""
    df = prep.impute(feature_table(t, P.NUMERIC_FEATURES))
    out = solvers.principal_shares(models.covariance(df, P.NUMERIC_FEATURES), k)
    return out.withColumn("share", F.round("share", 6))


def best_splits(t: Tables) -> DataFrame:
    """Each numeric feature's best first split of the training rows."""
    out = trees.best_splits(_part(t, "train", P.NUMERIC_FEATURES), P.NUMERIC_FEATURES, LABEL)
    return out.withColumn("threshold", F.round("threshold", 6))


def boosted_stumps(t: Tables) -> DataFrame:
    """The first rounds of boosting by stumps on the training rows."""
    out = trees.boosted_stumps(_part(t, "train", P.NUMERIC_FEATURES), P.NUMERIC_FEATURES, LABEL)
    return out.withColumns({c: F.round(c, 6) for c in ("threshold", "gain", "below", "above")})


def permutation_importance(t: Tables) -> DataFrame:
    """What each feature is worth to the written-down logistic model on the hold-out rows."""
    names = list(RULE_COEFFICIENTS)

    def predict(values):
        exact = {c: v.cast("decimal(19,0)") for c, v in values.items()}
        return F.when(models.exact_score(exact, RULE_COEFFICIENTS, RULE_INTERCEPT) > 0, 1).otherwise(0)

    return importance.permutation_importance(_part(t, "test", names), ID, LABEL, names, predict)


def code_cooccurrence(t: Tables) -> DataFrame:
    """Diagnosis codes at most two places apart, with positive pointwise mutual information."""
    pairs = cooccurrence.skip_grams(C.diag_sequence(t), "diag_icd_codes", window=2)
    pairs = io.store_and_reload(t.spark, {"pairs": pairs}, "code-pairs")["pairs"]
    return cooccurrence.ppmi(pairs)


RUNS = (lr_newton, pca_shares, best_splits, boosted_stumps, permutation_importance, code_cooccurrence)
