"""Numbered runs of a streaming table: one folder per batch, replaced if the batch is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _storage(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def run_path(table: str, kind: str, run: int) -> str:
    return f"{table}/kind={kind}/run={run}"


def runs(spark: SparkSession, table: str, kind: str) -> list[int]:
    """Numbers of the finished runs of a kind, in order."""
    storage, where = _storage(spark, f"{table}/kind={kind}")
    if not storage.exists(where):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(
        int(f.getPath().getName().split("=")[1]) for f in storage.listStatus(where)
        if storage.exists(path(f.getPath(), "_SUCCESS"))
    )


def write_run(df: DataFrame, table: str, kind: str, run: int) -> None:
    df.write.mode("overwrite").parquet(run_path(table, kind, run))


def read_runs(
    spark: SparkSession, table: str, chosen: list[tuple[str, int]], schema: StructType | str
) -> DataFrame:
    """Rows of some runs; no runs, no rows."""
    paths = [run_path(table, kind, run) for kind, run in chosen]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def drop_run(spark: SparkSession, table: str, kind: str, run: int) -> None:
    storage, where = _storage(spark, run_path(table, kind, run))
    storage.delete(where, True)
