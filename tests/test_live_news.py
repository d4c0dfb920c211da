"""News of orders meet what is stored of them in Spark, without a Python call per order."""

import random

from pyspark.sql import functions as F

from orderloom.operators import kpis
from orderloom.session import fresh_path
from orderloom.streaming import kpi_live, runs

from test_live_kpis import ORDERS, deliver, order, rows_of


def test_no_python_and_one_row_per_changed_order(spark):
    draw = random.Random(5)
    first = [(1, *order(i, draw)) for i in range(30)]
    old = [(0, *r[1:2], "canceled", *r[3:]) for r in first[:10]]
    table = deliver(spark, [first, old, [(2, *r[1:]) for r in first[:4]]])
    schema = spark.read.parquet(runs.run_path(table, "news", 0)).schema
    count = lambda batch: spark.read.schema(schema).parquet(runs.run_path(table, "news", batch)).count()
    assert [count(b) for b in range(3)] == [30, 0, 4]
    expected = rows_of(kpis.monthly(spark.createDataFrame([r[1:] for r in first], ORDERS)))
    assert rows_of(kpis.monthly_from_sums(kpi_live.current(spark, table))) == expected
    events = kpi_live.order_events(spark.createDataFrame([r[1:] for r in first], ORDERS), F.lit(1))
    signed = kpi_live._signed(spark, kpi_live.changes(events), fresh_path(spark, "kpi"), 0)
    for df in (kpi_live.changes(events), signed):
        assert "Pandas" not in df._jdf.queryExecution().executedPlan().toString()


def test_folded_orders_still_take_back(spark):
    draw = random.Random(6)
    first = [(1, *order(i, draw)) for i in range(12)]
    gone = [[(2 + k, *first[k][1:2], "canceled", *first[k][3:])] for k in range(5)]
    table = deliver(spark, [first, *gone], fold_every=2)
    assert runs.runs(spark, table, "known") == [3, 5]
    rows = [r[1:] for r in first[5:]]
    expected = rows_of(kpis.monthly(spark.createDataFrame(rows, ORDERS)))
    assert rows_of(kpis.monthly_from_sums(kpi_live.current(spark, table))) == expected
