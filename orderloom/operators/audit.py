"""Access log: building records, reading them back, and the usual investigations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import as_column, exact_mean, rounded
from ..functions.text import preview, redacted

# Size of a large result, logger and event names, suspicious parameter texts.
LARGE_RESULT_ROWS = 1000
LOGGER, EVENT = "orderloom.audit", "data_access"
SUSPICIOUS = r"UNION|DROP|--|;"


def level(status: Column | str, row_count: Column | str) -> Column:
    return (
        F.when(as_column(status) == "error", "ERROR")
        .when(as_column(row_count) > LARGE_RESULT_ROWS, "WARNING")
        .otherwise("INFO")
    )


def events(calls: DataFrame) -> DataFrame:
    """Access records of measured calls, sensitive parameters removed."""
    severity = level("status", "row_count")
    return calls.select(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        severity.alias("level"),
        "session",
        F.lit(LOGGER).alias("logger"),
        F.lit(EVENT).alias("event"),
        "function",
        redacted("params").alias("params"),
        "row_count",
        rounded("duration_ms", 2).alias("duration_ms"),
        preview("sql").alias("sql_preview"),
        "status",
        F.nullif("error", F.lit("")).alias("error"),
        F.when(
            severity == "WARNING",
            F.concat(F.lit("large_result_set:"), F.col("row_count").cast("string"),
                     F.lit("_rows")),
        ).alias("warning"),
    )


def data_access(log: DataFrame) -> DataFrame:
    return log.where(F.col("event") == EVENT)


def only_level(log: DataFrame, *levels: str) -> DataFrame:
    return log.where(F.col("level").isin(*levels))


def summary(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("total_queries"),
        rounded(exact_mean("duration_ms"), 1).alias("avg_duration_ms"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_distinct("session").alias("unique_sessions"),
    )


def calls_per_function(log: DataFrame) -> DataFrame:
    return log.groupBy("function").agg(F.count("*").alias("calls")).orderBy(
        F.desc("calls"), "function"
    )


def mean_duration(log: DataFrame) -> DataFrame:
    return log.groupBy("function").agg(
        rounded(exact_mean("duration_ms"), 4).alias("avg_ms")
    ).orderBy(F.desc("avg_ms"), "function")


def rows_per_function(log: DataFrame) -> DataFrame:
    return log.groupBy("function").agg(F.sum("row_count").alias("rows_returned"))


def narrowed(
    log: DataFrame, functions: Sequence[str] = (), statuses: Sequence[str] = ()
) -> DataFrame:
    """Optional selection of functions and statuses; empty means all."""
    if functions:
        log = log.where(F.col("function").isin(*functions))
    if statuses:
        log = log.where(F.col("status").isin(*statuses))
    return log


def history(log: DataFrame) -> DataFrame:
    """Newest first, time cut to seconds."""
    return log.select(
        F.translate(F.substring("timestamp", 1, 19), "T", " ").alias("timestamp"),
        "function", "row_count", "duration_ms", "status", "session",
        F.to_json("params").alias("params"),
    ).orderBy(F.desc("timestamp"), "session", "function", "row_count", "duration_ms")


def between(log: DataFrame, start: str, end: str) -> DataFrame:
    """ISO texts order like the times they stand for."""
    return log.where(F.col("timestamp").between(F.lit(start), F.lit(end)))


def bulk_reads(log: DataFrame) -> DataFrame:
    return only_level(log, "WARNING")


def of_session(log: DataFrame, session: str) -> DataFrame:
    return log.where(F.col("session") == F.lit(session))


def failures(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == "error")


def suspicious(log: DataFrame) -> DataFrame:
    return log.where(F.to_json("params").rlike(SUSPICIOUS))


def timeline(log: DataFrame, day: str) -> DataFrame:
    return (
        log.where(F.substring("timestamp", 1, 10) == F.lit(day))
        .select("timestamp", "session", "function", "row_count", "status")
        .orderBy("timestamp", "session", "function")
    )
