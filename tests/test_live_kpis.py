"""Monthly indicators from signed sums: merging, retraction, repeats, old news, folding."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import kpis
from orderloom.session import fresh_path
from orderloom.streaming import kpi_live, runs

ORDERS = """order_id long, order_status string, order_month timestamp_ntz, review_score int,
days_to_deliver long, delivered_on_time boolean, total_payment_value double,
has_review_comment boolean, used_voucher boolean"""


def order(key, draw, status="delivered"):
    maybe = lambda value: None if draw.random() < 0.2 else value
    return (key, status, dt.datetime(2020, draw.randrange(1, 5), 1), maybe(draw.randrange(1, 6)),
            maybe(draw.randrange(40)), maybe(draw.random() < 0.7),
            maybe(round(draw.uniform(0, 500), 2)), draw.random() < 0.3, maybe(draw.random() < 0.1))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def made(spark):
    draw = random.Random(3)
    rows = [order(i, draw, draw.choice(["delivered", "delivered", "canceled"])) for i in range(300)]
    return rows, spark.createDataFrame(rows, ORDERS)


def test_sums_give_the_same_indicators(made):
    _, orders = made
    assert rows_of(kpis.monthly_from_sums(kpis.monthly_sums(orders))) == rows_of(kpis.monthly(orders))


def test_parts_merge(made):
    _, orders = made
    half = F.col("order_id") % 2 == 0
    parts = kpis.monthly_sums(orders.where(half)).unionByName(kpis.monthly_sums(orders.where(~half)))
    assert rows_of(kpis.monthly_from_sums(kpis.merged_sums(parts))) == rows_of(kpis.monthly(orders))


def test_sums_taken_back_leave_no_month(made):
    _, orders = made
    sums = kpis.monthly_sums(orders)
    back = sums.select("order_month", *[(-F.col(a)).alias(a) for a in kpis.ADDENDS])
    assert kpis.merged_sums(sums.unionByName(back)).count() == 0


def deliver(spark, deliveries, fold_every=20):
    """News in several deliveries, a batch each; the table that follows them."""
    arrived, table, state = (fresh_path(spark, p) for p in ("events", "kpi", "state"))
    for rows in deliveries:
        events = kpi_live.order_events(spark.createDataFrame(
            [r[1:] for r in rows], ORDERS).withColumn(
            "version", F.element_at(F.create_map(*[F.lit(x) for r in rows for x in (r[1], r[0])]),
                                    F.col("order_id"))), F.col("version"))
        events.coalesce(1).write.mode("append").parquet(arrived)
        changes = kpi_live.changes(spark.readStream.schema(events.schema).parquet(arrived))
        kpi_live.follow(changes, table, state, fold_every).awaitTermination()
    return table


def test_news_replace_what_an_order_added(spark):
    draw = random.Random(8)
    latest, deliveries = {}, []
    for version in (1, 2, 3):
        rows = []
        for key in draw.sample(range(40), 25):
            status = draw.choice(["delivered", "delivered", "shipped", "canceled"])
            rows.append((version, *order(key, draw, status)))
            latest[key] = rows[-1][1:]
        deliveries.append(rows)
    # the first delivery once more, out of date by now, and the last one again
    deliveries += [deliveries[0], deliveries[2]]
    expected = rows_of(kpis.monthly(spark.createDataFrame(list(latest.values()), ORDERS)))
    table = deliver(spark, deliveries, fold_every=2)
    assert rows_of(kpis.monthly_from_sums(kpi_live.current(spark, table))) == expected
    # two totals were written and what the first one replaced is gone
    assert runs.runs(spark, table, "total") == [3] and runs.runs(spark, table, "delta") == [2, 3, 4]
    assert kpi_live._chosen(spark, table) == [("total", 3), ("delta", 4)]


def test_an_order_that_is_called_off_leaves(spark):
    draw = random.Random(1)
    first = [(1, *order(1, draw)), (1, *order(2, draw, "canceled"))]
    table = deliver(spark, [first, [(2, *first[0][1:2], "canceled", *first[0][3:])]])
    assert kpi_live.current(spark, table).count() == 0


def test_no_batch_yet(spark):
    assert kpi_live.current(spark, fresh_path(spark, "nothing")).count() == 0
