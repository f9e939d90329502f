"""Plans: nothing runs while they are built, and each table is read no more often than it must."""

import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardflow import session
from wardflow.plans import clinical as C
from wardflow.sources import io
from wardflow.plans import modelling as M
from wardflow.sources.synthetic import tables
from wardflow.sources.tables import SCHEMAS, ParquetTables, Tables, stage_tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return stage_tables(tables(spark, SF_SMALL), str(tmp_path_factory.mktemp("hosp")), partitions=2)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, table):
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}[\],]", plan(df)))


def test_building_the_feature_table_starts_no_job(spark, stored):
    for name in SCHEMAS:
        stored.get(name)  # opening a Parquet folder reads a footer
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    df = C.model_data(stored)
    C.comorbidity_index(stored), C.comorbidity_flags(stored)
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert scans(df, "diagnoses_icd") == 2 and scans(df, "procedures_icd") == 1 and scans(df, "prescriptions") == 1
    assert scans(df, "admissions") <= 6 and scans(df, "transfers") <= 2


def test_the_report_reads_its_input_once(spark, stored):
    from wardflow.operators.metrics import classification_report
    df = classification_report(stored.admissions.selectExpr("hospital_expire_flag as y", "hadm_id % 2 as p"), "y", "p")
    assert scans(df, "admissions") == 1


def test_unused_features_are_not_computed(spark, stored):
    text = plan(C.model_data(stored).select("hadm_id", "readmission_flag"))
    assert "listagg" not in text.lower()
    for run in (M._balanced_split, M._one_hot):
        assert run(stored).count() > 0


def test_stored_tables_equal_the_views(spark, stored):
    t = tables(spark, SF_SMALL)
    for name in SCHEMAS:
        assert stored.get(name).schema.fieldNames() == SCHEMAS[name].fieldNames()
        assert stored.get(name).exceptAll(t.get(name)).isEmpty() and t.get(name).exceptAll(stored.get(name)).isEmpty()
    with pytest.raises(KeyError):
        stored.get("nothing")


def test_catalog_tables(spark, stored):
    from wardflow.sources.tables import CatalogTables
    stored.admissions.createOrReplaceTempView("adm_of_test")
    t = CatalogTables(spark, names={"admissions": "adm_of_test"})
    assert t.admissions.exceptAll(stored.admissions).isEmpty()


def test_scratch_folders(spark):
    path = session.shared_dir(spark, "test")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Cluster())
    assert isinstance(stored_root(spark), str)


def stored_root(spark):
    return session.checkpoint_root(spark)


def test_parquet_tables_prune(spark, stored):
    assert isinstance(stored, ParquetTables)
    assert "ReadSchema: struct<subject_id:bigint>" in plan(stored.admissions.select("subject_id"))


def test_stored_features_are_joined_without_a_shuffle(spark, stored):
    df = C.model_data_bucketed(stored, buckets=3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 9, plan
    want = C.model_data(stored)
    assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()


def test_stored_tables_leave_the_catalog(spark):
    a, b = (io.store_bucketed(spark, {"x": spark.range(50).withColumn("v", F.col("id") * 2)}, ["id"], "t", 2)["x"] for _ in "ab")
    assert a.join(b.hint("merge"), "id").count() == 50
    files = a.inputFiles()
    assert len(files) == 2
    names = io.drop_bucketed(spark)
    assert len(names) >= 2 and not io.drop_bucketed(spark)
    assert spark.read.parquet(*files).count() == 50


def test_tables_bound_what_a_task_holds(spark):
    """Shuffles of event rows go to tasks of 8 MB at most; a session that asks for less keeps its setting."""
    was = spark.conf.get(session.ADVISORY)
    try:
        for set_to, held in (("64m", "8m"), ("67108864b", "8m"), ("1g", "8m"), ("16384k", "8m"), ("4m", "4m"), ("8388608", "8388608")):
            spark.conf.set(session.ADVISORY, set_to)
            ParquetTables(spark, SF_SMALL)
            assert spark.conf.get(session.ADVISORY) == held, set_to
    finally:
        spark.conf.set(session.ADVISORY, was)


def test_stay_frames_are_hashed_not_sorted(spark, stored):
    """The frames of a row per stay are the hashed sides of the feature table's joins: no task sorts them all."""
    text = plan(C.model_data(stored))
    assert text.count("ShuffledHashJoin") >= 9, text
    assert len(re.findall(r"SortMergeJoin \[subject_id[^\]]*hadm_id", text)) == 0, text


def test_generated_methods_stay_compiled(spark):
    was = spark.conf.get(session.METHOD_LIMIT)
    try:
        for set_to, held in (("65535", "8000"), ("8000", "8000"), ("4000", "4000")):
            spark.conf.set(session.METHOD_LIMIT, set_to)
            ParquetTables(spark, SF_SMALL)
            assert spark.conf.get(session.METHOD_LIMIT) == held
    finally:
        spark.conf.set(session.METHOD_LIMIT, was)


def test_joins_of_small_partitions_are_hashed(spark, stored):
    """Where no side can be sent to every task, the events of a stay are joined by hash, not by two sorts."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", session.LOCAL_MAP)}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set(session.LOCAL_MAP, "0b")
        df = C.drug_distinct(tables(spark, SF_SMALL))
        assert spark.conf.get(session.LOCAL_MAP) == "16m"
        assert df.count() == df._jdf.queryExecution().executedPlan().executeCollect().__len__()
        text = plan(df).split("== Initial Plan ==")[0]
        assert text.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in text, text
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_staged_groups_leave_their_rows_only(spark, stored):
    """Each group's shuffle files and written ranges are gone once it is stored; the joins shuffle nothing."""
    def left_over():
        return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()

    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session._own_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, folders, was = shuffle_files(spark), left_over(), spark.conf.get(session.CLEANUP)
    groups = C.staged_groups(stored, buckets=3)
    for _ in range(50):  # files are removed in the background
        more = shuffle_files(spark) - files
        if not more:
            break
        time.sleep(0.2)
    assert not more and spark.conf.get(session.CLEANUP) == was
    assert left_over() - folders == {groups.root.rsplit("/", 1)[-1]}
    df = C.model_data(stored, stored=groups)
    assert "Exchange" not in plan(df)
    want = C.model_data(stored)
    assert df.dtypes == want.dtypes and df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()
    tables_held = list(groups.tables)
    groups.drop()
    assert not left_over() - folders and not any(spark.catalog.tableExists(name) for name in tables_held)


def test_staged_groups_hold_what_the_columns_need(spark, stored):
    columns = ["hadm_id", "num_unique_drugs", "num_hospital_admissions"]
    groups = C.staged_groups(stored, columns, buckets=2)
    assert set(groups) == {"stays", "prescriptions"} and groups["prescriptions"].columns == ["subject_id", "hadm_id", "num_unique_drugs"]
    df, want = C.model_data(stored, stored=groups, columns=columns), C.model_data(stored).select(*columns)
    assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()


def test_staged_groups_of_a_stay_id_that_patients_share(spark, stored):
    """Rows per stay keys and ages per patient, as in one plan, where a stay id has two patients and a patient no age."""
    class Shared(Tables):
        def _load(self, name):
            df = stored.get(name)
            if name == "admissions":
                return df.unionByName(df.where("hadm_id < 60").withColumn("subject_id", F.col("subject_id") + 1))
            return df.withColumn("anchor_age", F.when(F.col("subject_id") % 7 > 0, F.col("anchor_age"))) if name == "patients" else df

    columns = ["subject_id", "hadm_id", "age", "charlson_comorbidity_index", "num_emar_medications"]
    t = Shared(spark)
    df, want = C.model_data_staged(t, columns), C.model_data(t, columns=columns)
    assert df.count() > stored.admissions.where("deathtime is null").count() and want.where("age is null").count() > 0
    assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty()


@pytest.mark.parametrize("name, exchanges", [("impute", 0), ("preview", 0), ("profile", 1), ("feature_covariance", 1)])
def test_feature_queries_shuffle_one_group_at_a_time(spark, name, exchanges):
    text = plan(M.QUERIES[name](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bExchange\b", text)) == exchanges, text
