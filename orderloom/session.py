"""Session settings and the shared folder that survives lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
CHECKPOINTS = "spark.checkpoint.dir"


def build_session(app_name: str = "orderloom", **overrides: str) -> SparkSession:
    """Session with the settings every operator assumes; overrides win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, used for everything handed from one job to the next.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session whose
    master is one machine (tests) gets a temporary folder; any other session gets an error,
    because a folder on one machine would be lost to the others.
    """
    named = spark.conf.get(CHECKPOINTS, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not _one_machine(context.master):
        raise ValueError(f"set {CHECKPOINTS} to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orderloom-"))
    return context.getCheckpointDir().rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """This session's part of the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """New path below the shared folder; never used twice."""
    return f"{own_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, wherever that is stored."""
    if not path.startswith(own_folder(spark)):
        raise ValueError(f"{path} is not in this session's part of the shared folder")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, wherever it is stored."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def handed_over(df: DataFrame, purpose: str = "rows") -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read back.

    Cuts the lineage, and fixes whatever depends on how Spark happened to split the rows: after
    a lost executor a recomputed split could differ, a stored one cannot. Unlike a row
    checkpoint the copy keeps its columns apart, so later readers prune and filter it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._handed_path = path
    return stored


def release(*handed: DataFrame) -> None:
    """Delete rows that ``handed_over`` returned, once nothing reads them any more."""
    for df in handed:
        remove(df.sparkSession, df._handed_path)


def collected(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now.

    Spark deletes them once the driver's JVM has collected what named them. With a heap that fills
    slowly that may be after the run, and the disk then holds every shuffle of a query at once.
    """
    spark._jvm.System.gc()


def release_all(spark: SparkSession) -> None:
    """Delete everything this session has handed over; its lazy results end with it."""
    remove(spark, own_folder(spark))
