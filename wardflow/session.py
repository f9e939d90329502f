"""Spark session and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Semantics do not depend on the session zone (all times are TIMESTAMP_NTZ and
# no operator converts them), but a fixed zone keeps printed values stable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Methods above 8000 bytes of bytecode are never JIT-compiled by the JVM;
    # fall back to smaller, non-fused code for such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "wardflow", extra: dict | None = None) -> SparkSession:
    """Session for scripts and tests; on a cluster pass master=None and let the
    launcher decide."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_UNITS = {"": 1, "b": 1, "k": 2 ** 10, "kb": 2 ** 10, "m": 2 ** 20, "mb": 2 ** 20, "g": 2 ** 30, "gb": 2 ** 30}
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def narrow_partitions(spark: SparkSession, megabytes: int = 8) -> None:
    """Let adaptive execution put at most so many MB of shuffled rows into a task, unless the session asks for less.

    Event rows are a few numbers and short codes, which a shuffle packs to some bytes a row: Spark's 64 MB of them are
    millions of rows, and gigabytes once a task sorts or groups them.
    """
    size = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(ADVISORY).strip().lower())
    if size and int(size[1]) * _UNITS.get(size[2], 0) > megabytes * _UNITS["m"]:
        spark.conf.set(ADVISORY, f"{megabytes}m")


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession, limit: int = 8000) -> None:
    """Keep generated methods to what the JVM compiles (8000 bytes of bytecode), unless the session asks for less: longer
    ones, as code rules and wide joins give, are interpreted for every row; Spark splits them below this limit."""
    if int(spark.conf.get(METHOD_LIMIT)) > limit:
        spark.conf.set(METHOD_LIMIT, str(limit))


LOCAL_MAP = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def hashed_joins(spark: SparkSession, megabytes: int = 16) -> None:
    """Let adaptive execution hash a join's side if each of its shuffle partitions, as measured, is at most so many MB: it takes
    the place of two sorts, each of which holds a page of up to 64 MB of a task at least. Larger partitions are merged as before."""
    size = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(LOCAL_MAP).strip().lower())
    if size and int(size[1]) * _UNITS.get(size[2], 0) < megabytes * _UNITS["m"]:
        spark.conf.set(LOCAL_MAP, f"{megabytes}m")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, also set as Spark's checkpoint folder.

    Where the session names none, a scratch folder is made if the master is
    local (tests); on a cluster this is an error, since every executor would
    write to a disk of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wardflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def _own_dir(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/wardflow/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder for a written table, under the shared root and the application's id."""
    return f"{_own_dir(spark)}/{_SCRATCH.get()}{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are written to ``shared_dir`` inside are removed at the end: for steps whose result is stored elsewhere."""
    own = f"{_SCRATCH.get()}scratch-{uuid.uuid4().hex[:12]}"
    held = _SCRATCH.set(f"{own}/")
    try:
        yield
    finally:
        _SCRATCH.reset(held)
        drop_path(spark, f"{_own_dir(spark)}/{own}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs inside go when it ends; Spark keeps them until the driver happens to collect
    its garbage. For writes: a frame that is run again would have to make them again."""
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, was)


def drop_path(spark: SparkSession, folder: str) -> None:
    """Remove a table that this application wrote to the shared root."""
    if not folder.startswith(f"{_own_dir(spark)}/"):
        raise ValueError(f"{folder} isn't a folder of this application")
    _delete(spark, folder)


def drop_shared(spark: SparkSession) -> None:
    """Remove all tables that this application wrote to the shared root. Results still to be read must not need them."""
    _delete(spark, _own_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)
