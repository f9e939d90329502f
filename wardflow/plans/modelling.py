"""From the feature table to trained and evaluated classifiers.

model_data -> impute -> drop identifiers / times / free text -> one-hot ->
exact balanced split (+ complement) -> stratified folds -> grid search ->
scoring -> classification report / model table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators import metrics, models, prep
from wardflow.plans import clinical as C
from wardflow.profiles import clinical as P
from wardflow.sources import io
from wardflow.sources.local import local_frame
from wardflow.sources.synthetic import tables
from wardflow.sources.tables import Tables

ID = P.EPISODE
LABEL = P.LABEL


def feature_table(t: Tables, columns=None) -> DataFrame:
    """The feature table, or the ``columns`` of it that a run needs, written once to the
    shared folder and read back: the steps of a run start from this copy (as from an export),
    and what it doesn't hold is never computed."""
    df = C.model_data(t, ranges=True, columns=columns)
    return io.store_and_reload(t.spark, {"features": df}, "features")["features"]


def imputed(t: Tables, features: DataFrame | None = None) -> DataFrame:
    return prep.impute(C.model_data_staged(t) if features is None else features)


TRAINING_COLUMNS = [c for c in P.MODEL_DATA_COLUMNS if c not in P.TRAINING_DROP or c == ID]


def training_frame(t: Tables, features: DataFrame | None = None) -> DataFrame:
    """Imputed feature table without identifiers, times and code text, with
    one-hot race and DRG type; ``hadm_id`` is kept as the row identity."""
    features = feature_table(t, TRAINING_COLUMNS) if features is None else features
    df = prep.impute(features).select(*TRAINING_COLUMNS)
    values = prep.categories_of(df, P.CATEGORICAL)
    for c in P.CATEGORICAL:
        df = prep.one_hot(df, c, values[c])
    return df


def feature_columns(df: DataFrame) -> list[str]:
    """The columns of ``df`` that are features by name: the numeric ones and the one-hot ones, nothing else."""
    one_hot = tuple(f"{c}_" for c in P.CATEGORICAL)
    return [c for c in df.columns if c in P.NUMERIC_FEATURES
            or (c.startswith(one_hot) and c not in P.MODEL_DATA_COLUMNS)]


def feature_matrix(t: Tables) -> DataFrame:
    """(hadm_id, readmission_flag, features): the numbers that the models see, in the order of ``feature_columns``."""
    df = training_frame(t)
    return df.select(ID, LABEL, F.array(*[F.col(f"`{c}`").cast("double") for c in feature_columns(df)]).alias("features"))


def split_frame(t: Tables, features: DataFrame | None = None) -> DataFrame:
    return prep.balanced_split(training_frame(t, features), LABEL, ID)


def with_folds(train: DataFrame, k: int = 3) -> DataFrame:
    return prep.stratified_folds(train, LABEL, ID, k=k)


def rule_prediction(df: DataFrame) -> DataFrame:
    """A fixed rule used to exercise the report: predict a return when the
    patient had an earlier emergency admission."""
    return df.select(ID, LABEL, F.when(F.col("num_prev_emergency") > 0, 1).otherwise(0).alias("prediction"))


def rule_score(df: DataFrame) -> DataFrame:
    """A fixed score with many distinct values and ties, for ROC-AUC."""
    s = F.coalesce(F.col("num_prescribed_days"), F.lit(0)).cast("double") + F.col("num_prev_emergency") / F.lit(10.0)
    return df.select(ID, LABEL, s.alias("score"))


# ---------------------------------------------------------------------------
# Model runs
# ---------------------------------------------------------------------------

class Vectors:
    """The table that models are fit on, written once: ``hadm_id``, label, ``split``, ``fold`` (training rows) and one
    ``features`` vector, the numbers first and then a slot per value of each categorical column. However many values
    there are, no table gets wider and none reaches the driver."""

    def __init__(self, t: Tables, folds: int = 3):
        spark = t.spark
        rows = prep.impute(feature_table(t, TRAINING_COLUMNS)).select(*TRAINING_COLUMNS)
        self.codes = io.store_and_reload(spark, {c: prep.category_codes(rows, c) for c in P.CATEGORICAL}, "categories")
        split = prep.balanced_split(rows, LABEL, ID)
        in_folds = with_folds(split.where(F.col("split") == "train").select(ID, LABEL), folds).select(ID, "fold")
        for c, codes in self.codes.items():
            split = prep.one_hot_vector(split, c, f"{c}_vec", codes)
        whole = models.assembler([*P.NUMERIC_FEATURES, *[f"{c}_vec" for c in P.CATEGORICAL]]).transform(split.join(in_folds, ID, "left"))
        whole = whole.select(ID, F.col(LABEL).cast("double").alias(LABEL), "split", "fold", "features")
        self.table = io.store_and_reload(spark, {"vectors": whole}, "vectors")["vectors"]

    @property
    def train(self) -> DataFrame:
        return models.sized(self.table.where(F.col("split") == "train").select(ID, LABEL, "fold", "features"), ID)

    @property
    def test(self) -> DataFrame:
        return self.table.where(F.col("split") == "test").select(ID, LABEL, "features")

    def slots(self) -> DataFrame:
        """(slot, feature): the name of each slot of the vectors."""
        spark = self.table.sparkSession
        out = local_frame(spark, [(i, c) for i, c in enumerate(P.NUMERIC_FEATURES)], "slot long, feature string")
        first = len(P.NUMERIC_FEATURES)
        for c, codes in self.codes.items():
            out = out.unionByName(codes.select((F.col("code") + first).alias("slot"), F.concat(F.lit(f"{c}_"), "value").alias("feature")))
            first += codes.count()
        return out


MODELS = ("LogisticRegression", "RandomForest", "GradientBoosting")


def fit_and_score(t: Tables, name: str, **params) -> DataFrame:
    v = Vectors(t)
    train = v.train.cache()
    model = models.fitted(name, train, LABEL, train.count(), **params)
    scored = models.score(model, v.test, LABEL, keep=(ID,))
    train.unpersist()
    return scored


def grid_search_table(t: Tables, names=MODELS, grids=models.GRIDS) -> DataFrame:
    train = Vectors(t).train.cache()
    rows = []
    for name in names:
        rows.extend(models.grid_search(train, LABEL, "fold", name, grids[name], refit=False)[1])
    train.unpersist()
    return local_frame(t.spark, rows, "model string, params string, mean_accuracy double")


def model_table(t: Tables, names=MODELS, grids=models.GRIDS) -> DataFrame:
    """Per model: best grid point by cross-validated accuracy, refit on the
    whole training part, scored on the held-out part; weighted-average
    precision / recall / F1 / support and accuracy."""
    v = Vectors(t)
    train = v.train.cache()
    counts = {}
    for name in names:
        model, _ = models.grid_search(train, LABEL, "fold", name, grids[name])
        scored = models.score(model, v.test, LABEL, keep=(ID,))
        counts[name] = metrics.confusion(scored, LABEL, "prediction").withColumn("model", F.lit(name))
    train.unpersist()
    # The confusion counts of all models, a few rows each, written; then a report for each of them.
    stored = io.store_and_reload(t.spark, counts, "confusion")
    out = None
    for name in names:
        rep = metrics.report_of(stored[name])
        weighted = F.col("class_label") == "weighted avg"
        row = rep.agg(
            F.lit(name).alias("model"),
            *[F.max(F.when(weighted, F.col(c))).alias(c) for c in ("precision", "recall", "f1_score", "support")],
            F.max(F.when(F.col("class_label") == "accuracy", F.col("precision"))).alias("accuracy"))
        out = row if out is None else out.unionByName(row)
    return out


def feature_importance(t: Tables, num_trees: int = 100, max_depth: int = 10) -> DataFrame:
    """(feature, importance, coefficient): of the random forest, and of the logistic regression."""
    v = Vectors(t)
    train = v.train.cache()
    forest = models.random_forest(LABEL, num_trees, max_depth).fit(train)
    linear = models.logistic_regression(LABEL, train.count()).fit(train)
    train.unpersist()
    rows = zip(forest.featureImportances.toArray().tolist(), linear.coefficients.toArray().tolist())
    found = local_frame(t.spark, [(i, *r) for i, r in enumerate(rows)], "slot long, importance double, coefficient double")
    return v.slots().join(found, "slot").select("feature", "importance", "coefficient")


def one_hot_vectors(t: Tables) -> DataFrame:
    """Per stay and categorical column the size of the 0/1 vector and its slot that is 1 (NULL: none)."""
    df = feature_table(t, [ID, *P.CATEGORICAL])
    out = None
    for c in P.CATEGORICAL:
        vector = F.unwrap_udt(F.col("vector"))
        rows = prep.one_hot_vector(df.select(ID, c), c, "vector").select(
            ID, F.lit(c).alias("column_name"), vector["size"].cast("long").alias("size"), F.get(vector["indices"], 0).cast("long").alias("slot"))
        out = rows if out is None else out.unionByName(rows)
    return out


def code_embeddings(t: Tables) -> DataFrame:
    return models.code_embeddings(C.diag_sequence(t), P.STAY_KEYS, "diag_icd_codes")


def procedure_embeddings(t: Tables) -> DataFrame:
    return models.code_embeddings(C.proc_sequence(t), P.STAY_KEYS, "proc_icd_codes")


def embedding_vocabulary(t: Tables) -> DataFrame:
    """(sequence, code, n): how often each code occurs in the sequences that the embeddings are trained on."""
    parts = []
    for name, seqs in (("diag_icd_codes", C.diag_sequence(t)), ("proc_icd_codes", C.proc_sequence(t))):
        codes = seqs.select(F.explode(F.split(name, " ")).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
        parts.append(codes.select(F.lit(name).alias("sequence"), "code", "n"))
    return parts[0].unionByName(parts[1])


def pca_variance(t: Tables, k: int = 5) -> DataFrame:
    df = training_frame(t)
    return models.pca_variance(df, feature_columns(df), k=k)


def feature_covariance(t: Tables) -> DataFrame:
    """Covariances of the numeric features, which principal components start from."""
    df = prep.impute(C.model_data_staged(t, P.NUMERIC_FEATURES))
    return models.covariance(df, P.NUMERIC_FEATURES).withColumn("covariance", F.round("covariance", 6))


# A logistic model written down, to check scoring by.
RULE_COEFFICIENTS = {"num_prev_emergency": 0.8, "num_procedures": -0.25, "age": -0.01, "charlson_comorbidity_index": 0.125}
RULE_INTERCEPT = -0.5


def scored_rows(t: Tables) -> DataFrame:
    """The hold-out rows scored by a fixed logistic model."""
    features = feature_table(t, [ID, LABEL, *RULE_COEFFICIENTS])
    test = prep.balanced_split(prep.impute(features), LABEL, ID).where(F.col("split") == "test")
    out = models.linear_scores(test, RULE_COEFFICIENTS, RULE_INTERCEPT)
    return out.select(ID, LABEL, "prediction", F.round("probability_1", 9).alias("probability_1"))


# ---------------------------------------------------------------------------
# Source / sink round trips
# ---------------------------------------------------------------------------

def roundtrip_derived(t: Tables) -> DataFrame:
    """Store age, readmission and comorbidity index, then build the feature
    table from the stored copies (as the source pipeline does)."""
    stored = io.store_and_reload(t.spark, {
        "age": C.age(t),
        "readmission": C.readmission(t, ranges=True),
        "comorbidity_index": C.comorbidity_index(t),
    }, "derived")
    return C.model_data(t, stored=stored, ranges=True)


def csv_roundtrip(t: Tables) -> DataFrame:
    from wardflow.session import shared_dir
    groups = C.staged_groups(t)
    path = io.write_feature_csv(C.model_data(t, stored=groups), shared_dir(t.spark, "model_data_csv"), compression="gzip")
    groups.drop()
    return io.read_feature_csv(t.spark, path)


# ---------------------------------------------------------------------------
# Registry entries
# ---------------------------------------------------------------------------

def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


def _one_hot(t):
    df = feature_table(t, [ID, *P.CATEGORICAL])
    values = prep.categories_of(df, P.CATEGORICAL)
    for c in P.CATEGORICAL:
        df = prep.one_hot(df, c, values[c])
    return df


def _labels_split(t, *more):
    """The split of a run that needs the rows' ids and labels, and ``more`` columns, only."""
    return prep.balanced_split(feature_table(t, [ID, LABEL, *more]), LABEL, ID)


def _balanced_split(t):
    return _labels_split(t)


def _stratified_folds(t):
    train = _labels_split(t).where(F.col("split") == "train")
    return with_folds(train).select(ID, LABEL, "fold")


def _fold_confusion(t):
    train = _labels_split(t, "num_prev_emergency").where(F.col("split") == "train")
    folds = with_folds(train.withColumn("prediction", F.when(F.col("num_prev_emergency") > 0, 1).otherwise(0)))
    return metrics.fold_confusion(folds, LABEL, "prediction", "fold")


def _group_split(t):
    return prep.group_split(C.model_data(t).select(P.ENTITY, ID), P.ENTITY)


def _class_balance(t):
    features = feature_table(t, [ID, LABEL])
    s = prep.balanced_split(features, LABEL, ID)
    parts = [prep.class_shares(features, LABEL, "all"),
             prep.class_shares(s.where(F.col("split") == "train"), LABEL, "train"),
             prep.class_shares(s.where(F.col("split") == "test"), LABEL, "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _profile(t):
    return prep.profile(C.model_data_staged(t))


def _preview(t):
    return C.model_data_staged(t).orderBy(ID).limit(5)


def _report(t):
    return metrics.classification_report(rule_prediction(C.model_data(t)), LABEL, "prediction")


def _fnr(t):
    return metrics.false_negative_rate(rule_prediction(C.model_data(t)), LABEL, "prediction")


def _auc(t):
    return metrics.roc_auc(rule_score(C.model_data(t)), LABEL, "score")


def _roc_curve(t):
    return metrics.roc_curve(rule_score(C.model_data(t)), LABEL, "score")


def _lr(t):
    return fit_and_score(t, "LogisticRegression")


def _rf(t):
    return fit_and_score(t, "RandomForest", numTrees=100, maxDepth=20)


def _gbt(t):
    return fit_and_score(t, "GradientBoosting", maxIter=100, stepSize=0.1)


QUERIES = {
    "impute": _q(imputed),
    "one_hot": _q(_one_hot),
    "training_frame": _q(training_frame),
    "balanced_split": _q(_balanced_split),
    "stratified_folds": _q(_stratified_folds),
    "class_balance": _q(_class_balance),
    "profile": _q(_profile),
    "preview": _q(_preview),
    "classification_report": _q(_report),
    "false_negative_rate": _q(_fnr),
    "roc_auc": _q(_auc),
    "roundtrip_derived": _q(roundtrip_derived),
    "csv_roundtrip": _q(csv_roundtrip),
    "lr_fit": _q(_lr),
    "rf_fit": _q(_rf),
    "gbt_fit": _q(_gbt),
    "grid_search": _q(grid_search_table),
    "model_table": _q(model_table),
    "feature_importance": _q(feature_importance),
    "code_embeddings": _q(code_embeddings),
    "procedure_embeddings": _q(procedure_embeddings),
    "embedding_vocabulary": _q(embedding_vocabulary),
    "feature_matrix": _q(feature_matrix),
    "one_hot_vectors": _q(one_hot_vectors),
    "feature_covariance": _q(feature_covariance),
    "scored_rows": _q(scored_rows),
    "fold_confusion": _q(_fold_confusion),
    "group_split": _q(_group_split),
    "roc_curve": _q(_roc_curve),
    "pca_variance": _q(pca_variance),
}
