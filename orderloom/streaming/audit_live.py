"""Access-log rollup that keeps up with a growing log.

A batch adds its events to the windows that are still open. Once the log has moved past the end
of a window by the allowed lateness, the window is written for good; events that come for it
afterwards are counted as late and change nothing. So what a batch reads is the open windows of
the batch before it, however long the log has become.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import exact, ratio, rounded
from ..sources import schemas
from . import runs

WINDOW, LATENESS = "1 hour", "10 minutes"
#: Batches whose closed windows share a file in the end.
FOLD_EVERY = 20
KEYS = ("window_start", "window_end", "function")
SUMS = {
    "calls": "bigint", "errors": "bigint", "rows_returned": "bigint",
    "duration_sum": "decimal(38,8)", "timed_calls": "bigint",
}
OPEN = "window_start timestamp, window_end timestamp, function string, " + ", ".join(
    f"{n} {t}" for n, t in SUMS.items()
)
MARK = "seen timestamp, events bigint, late bigint"


def read_log_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """Files appended to the log folder, in order of arrival."""
    reader = spark.readStream.schema(schemas.struct(schemas.AUDIT_LOG))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path).where("event = 'data_access'")


def _timed(log: DataFrame, window: str) -> DataFrame:
    timed = log.withColumn("at", F.try_to_timestamp("timestamp")).where("at IS NOT NULL")
    span = F.window("at", window)
    return timed.select("*", span["start"].alias("window_start"), span["end"].alias("window_end"))


def _window_sums(timed: DataFrame) -> DataFrame:
    """Additive sums of every window and function."""
    return timed.groupBy(*KEYS).agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.sum("row_count").alias("rows_returned"),
        F.sum(exact("duration_ms")).alias("duration_sum"),
        F.count("duration_ms").alias("timed_calls"),
    )


def _shown(sums: DataFrame) -> DataFrame:
    return sums.select(
        "window_start", "function", "calls", "errors", "rows_returned",
        rounded(ratio("duration_sum", "timed_calls"), 4).alias("avg_ms"),
    )


def rollup(log: DataFrame, window: str = WINDOW) -> DataFrame:
    """Calls, errors and mean time per window and function of a whole log."""
    return _shown(_window_sums(_timed(log, window)))


def _watermark(seen: Column, lateness: str) -> Column:
    return seen - F.expr(f"INTERVAL {lateness}")


def follow(
    log: DataFrame, table: str, checkpoint: str, window: str = WINDOW, lateness: str = LATENESS,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Process what has arrived of a log stream and stop; call again for newer files.

    Every batch writes three runs under its number: ``mark`` (newest event seen, events and late
    events so far), ``open`` (sums of the windows that may still change) and, if there are any,
    ``closed`` (windows that are final, written once). It reads the mark and the open windows of
    the batch before, so a batch that is repeated after a failure does the same again. Of older
    marks and open windows nothing is kept; every ``fold_every`` batches the closed windows since
    the last time are put into one run. Events without a readable time are left out.

    An event is late if its window had closed before its batch. The open windows are bounded by
    the lateness and the number of functions.
    """
    def write(events: DataFrame, batch: int) -> None:
        spark = events.sparkSession
        earlier = [r for r in runs.runs(spark, table, "mark") if r < batch][-1:]
        mark = runs.read_runs(spark, table, [("mark", r) for r in earlier], MARK).first()
        seen, n_events, n_late = tuple(mark) if mark else (None, 0, 0)
        timed = _timed(events, window).persist()
        try:
            bound = _watermark(F.lit(seen).cast("timestamp"), lateness)
            late = F.coalesce(F.col("window_end") <= bound, F.lit(False))
            news = timed.agg(
                F.max("at").alias("seen"), F.count("*").alias("events"),
                F.count_if(late).alias("late"),
            ).first()
            if not news.events and earlier:
                return
            reached = max(x for x in (seen, news.seen) if x is not None) if news.events else seen
            before = runs.read_runs(spark, table, [("open", r) for r in earlier], OPEN)
            fresh = _window_sums(timed.where(~late))
            merged = before.unionByName(fresh).groupBy(*KEYS).agg(
                *[F.sum(c).cast(kind).alias(c) for c, kind in SUMS.items()]
            ).persist()
            try:
                final = F.coalesce(
                    F.col("window_end") <= _watermark(F.lit(reached).cast("timestamp"), lateness),
                    F.lit(False),
                )
                closed = merged.where(final)
                if not closed.isEmpty():
                    runs.write_run(closed, table, "closed", batch)
                runs.write_run(merged.where(~final), table, "open", batch)
            finally:
                merged.unpersist()
            runs.write_run(
                spark.createDataFrame([(reached, n_events + news.events, n_late + news.late)], MARK),
                table, "mark", batch,
            )
        finally:
            timed.unpersist()
        for kind in ("mark", "open"):
            for old in runs.runs(spark, table, kind):
                if old < (earlier or [batch])[0]:
                    runs.drop_run(spark, table, kind, old)
        _fold(spark, table, batch, fold_every)

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _fold(spark: SparkSession, table: str, batch: int, every: int) -> None:
    """Put the closed windows of the last batches into one run, numbered by the last of them.

    The run is finished before the parts go, and readers leave out parts that it covers.
    """
    if batch % every != every - 1:
        return
    parts = _uncovered(spark, table)
    if len(parts) > 1:
        last = parts[-1]
        rows = runs.read_runs(spark, table, [("closed", r) for r in parts], OPEN)
        runs.write_run(rows.coalesce(1), table, "folded", last)
    folded = runs.runs(spark, table, "folded")
    for old in runs.runs(spark, table, "closed"):
        if folded and old <= folded[-1]:
            runs.drop_run(spark, table, "closed", old)


def _uncovered(spark: SparkSession, table: str) -> list[int]:
    folded = runs.runs(spark, table, "folded")
    return [r for r in runs.runs(spark, table, "closed") if not folded or r > folded[-1]]


def current(spark: SparkSession, table: str) -> DataFrame:
    """Every window as it stands: the closed ones and the open ones of the last batch."""
    chosen = [("folded", r) for r in runs.runs(spark, table, "folded")]
    chosen += [("closed", r) for r in _uncovered(spark, table)]
    chosen += [("open", r) for r in runs.runs(spark, table, "open")[-1:]]
    return _shown(runs.read_runs(spark, table, chosen, OPEN))


def lateness_report(spark: SparkSession, table: str) -> DataFrame:
    """seen, events, late: newest event, and how many came at all and too late."""
    last = runs.runs(spark, table, "mark")[-1:]
    return runs.read_runs(spark, table, [("mark", r) for r in last], MARK)
