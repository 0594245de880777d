"""Session defaults and the shared folder for pinned intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "corpusloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local, as in tests, a temporary folder takes its
    place: on a cluster a machine-local path would be lost with its executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's own folder in the shared folder.

    Everything an application pins lies in that one folder, which may be deleted after it ended.
    """
    return f"{shared_root(spark)}/corpusloom-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str, task_rows: int | None = None) -> DataFrame:
    """Hash a scan over all cores if its files give fewer splits than that; else leave it alone.

    For CPU-bound expressions over small or coarsely split input. A large table has splits enough
    and is not shuffled. ``task_rows`` is for short rows that take long: a task gets about that many, however many a split
    holds (counts ``df``, which reads no columns of a stored table).
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if task_rows is not None:
        tasks = max(tasks, -(-df.count() // task_rows))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, key)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it from there; its shuffle files go as soon as it is written.

    Else they stay on the executors' disks until the driver happens to collect its garbage, beside those of the next steps.
    No mark of success is written, which nothing here reads: on a local file system Hadoop starts processes from the driver
    to set its mode, and until each has loaded its program it shares the driver's memory, which then counts twice.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it from there (an action).

    Used where a result is read twice and both reads must see the same rows, or where
    recomputing would scan the corpus again. The table survives the loss of executors, later
    readers take only the columns they need, and its file sizes give Spark true statistics.
    """
    return store(df, shared_path(df.sparkSession, "pinned"))
