"""Spark session helper and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scratch_paths: list[str] = []
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing, _waiting, _before = threading.Lock(), [], []


def get_session(app_name: str = "ledgerlens", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        if key == "master":
            builder = builder.master(value)
        else:
            builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared scratch folder."""
    path = f"{scratch_root(spark)}/ledgerlens-{label}-{uuid.uuid4().hex}"
    _scratch_paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet to shared storage and read it back.

    Unlike a cache this survives lost executors, and later stages still get column
    pruning and filter pushdown.
    """
    return store(df, scratch_path(df.sparkSession, label))


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the jobs that run inside are deleted when these end; else they stay until the driver happens to
    collect its garbage. For plans that are run once, such as a write. Threads may do so side by side."""
    with _freeing:
        if not _waiting:
            _before.append(spark.conf.get(_FREED))
            spark.conf.set(_FREED, "true")
        _waiting.append(1)
    try:
        yield
    finally:
        with _freeing:
            _waiting.pop()
            if not _waiting:
                spark.conf.set(_FREED, _before.pop())


def store(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def stored_while(df: DataFrame, label: str):
    """``df`` written and read back as ``materialize`` does, and deleted at the end; threads may do so side by side."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        yield store(df, path)
    finally:
        forget(spark, path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete one scratch folder."""
    _scratch_paths.remove(path)
    _delete(spark, path)


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """At most ``rows`` rows in an Arrow batch, for the jobs that run inside: a batch of wide rows stands in the JVM and
    in the Python worker at once."""
    before = spark.conf.get(_BATCH_ROWS)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders made inside are deleted at the end: for work whose results are stored elsewhere by then."""
    before = len(_scratch_paths)
    try:
        yield
    finally:
        release_scratch(spark, keep=before)


def release_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete the scratch folders this process created (but the first ``keep``); returns how many were removed."""
    removed = 0
    while len(_scratch_paths) > keep:
        removed += _delete(spark, _scratch_paths.pop())
    return removed
