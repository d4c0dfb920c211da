"""The followed access log: closed windows, late events, repeated batches, bounded reading."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderloom.session import fresh_path
from orderloom.streaming import audit_live, runs

EVENT = "timestamp string, event string, function string, row_count long, duration_ms double, status string"


def event(at, function="f", status="success", ms=1.5):
    return (at.isoformat(), "data_access", function, 3, ms, status)


def start(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def follow(spark, deliveries, fold_every=20, state=None, table=None, log=None):
    log, table, state = (x or fresh_path(spark, n) for x, n in
                         ((log, "log"), (table, "live"), (state, "state")))
    for rows in deliveries:
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").json(log)
        stream = audit_live.read_log_stream(spark, log)
        audit_live.follow(stream, table, state, fold_every=fold_every).awaitTermination()
    return table


def shown(df):
    return sorted(map(tuple, df.collect()))


def brute(deliveries, lateness=10):
    """Windows of an hour, one delivery a batch; the windows, and the number of late events."""
    kept, seen, late = [], None, 0
    for rows in deliveries:
        for r in rows:
            end = dt.datetime.fromisoformat(r[0]).replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
            if seen is not None and end <= seen - dt.timedelta(minutes=lateness):
                late += 1
            else:
                kept.append(r)
        times = [dt.datetime.fromisoformat(r[0]) for r in rows]
        seen = max([*times, *([seen] if seen else [])], default=None)
    return kept, late


def test_late_events_are_counted_and_change_nothing(spark):
    draw = random.Random(6)
    deliveries = [
        [event(start(60 * hour + draw.randrange(-150, 60)), draw.choice("fg"),
               draw.choice(["success", "error"]), draw.choice([None, 0.25, 7.125]))
         for _ in range(40)]
        for hour in range(5, 11)
    ]
    kept, late = brute(deliveries)
    assert 0 < late < 100
    table = follow(spark, deliveries)
    expected = audit_live.rollup(spark.createDataFrame(kept, EVENT))
    assert shown(audit_live.current(spark, table)) == shown(expected)
    report = audit_live.lateness_report(spark, table).first()
    assert (report.events, report.late) == (240, late)


def test_reading_does_not_grow_with_batches(spark):
    deliveries = [[event(start(90 * i))] for i in range(9)]
    table = follow(spark, deliveries, fold_every=4)
    # batches 3 and 7 folded; only the last two states of the open windows are left
    assert runs.runs(spark, table, "folded") == [3, 7] and runs.runs(spark, table, "closed") == [8]
    assert runs.runs(spark, table, "open") == [7, 8] and runs.runs(spark, table, "mark") == [7, 8]
    assert runs.read_runs(spark, table, [("open", 8)], audit_live.OPEN).count() == 1
    expected = audit_live.rollup(spark.createDataFrame([r for d in deliveries for r in d], EVENT))
    assert shown(audit_live.current(spark, table)) == shown(expected)


def test_a_repeated_batch_replaces_itself(spark):
    """A batch that failed after it wrote is run again with the same number."""
    deliveries = [[event(start(0))], [event(start(100)), event(start(20))], [event(start(300))]]
    table = follow(spark, deliveries)
    before = shown(audit_live.current(spark, table))
    log = fresh_path(spark, "log")
    spark.createDataFrame(deliveries[2], EVENT).write.json(log)
    written = []

    class Stream:
        """Runs the batch function once more, as number 2."""
        def __getattr__(self, _):
            return lambda *a, **k: (written.append(a[0]) if a and callable(a[0]) else None) or self

    class Log:
        writeStream = Stream()

    audit_live.follow(Log(), table, fresh_path(spark, "state"))
    written[0](spark.createDataFrame(deliveries[2], EVENT), 2)
    assert shown(audit_live.current(spark, table)) == before
    assert audit_live.lateness_report(spark, table).first().events == 4


def test_empty_and_unreadable_deliveries(spark):
    table = follow(spark, [[("never", "data_access", "f", 1, 1.0, "success")], [event(start(1))],
                           [("", "data_access", "f", 1, 1.0, "success")], [event(start(2))]])
    assert [r[2] for r in shown(audit_live.current(spark, table))] == [2]
    assert tuple(audit_live.lateness_report(spark, table).first())[1:] == (2, 0)
    nothing = fresh_path(spark, "nothing")
    assert audit_live.current(spark, nothing).count() == 0
    assert audit_live.lateness_report(spark, nothing).count() == 0
