"""Stored layouts: orders that meet without a shuffle, months that are rebuilt alone, and checks
that read a table once."""

import datetime as dt
import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.operators import kpis, quality
from orderloom.plans import months
from orderloom.plans.shop import Shop
from orderloom.session import fresh_path
from orderloom.sources import schemas, tables


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def by_order(spark, small_folder):
    shop = Shop.over_fixtures(spark, small_folder)
    schema = f"by_order_{uuid.uuid4().hex[:8]}"
    tables.create_schema(spark, schema)
    counts = tables.store_by_order({n: shop.src[n] for n in schemas.SOURCES}, schema, 4)
    assert counts["orders"] == shop.src["orders"].count()
    return shop, Shop.over_tables(spark, schema)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def test_no_shuffle_on_the_order_between_stored_tables(by_order, no_broadcast):
    plain, stored = by_order
    assert any("hashpartitioning(order_id" in e for e in exchanges(plain.int_orders))
    assert exchanges(stored.int_orders) == []
    for line in exchanges(stored.fct_orders):
        # the account's key alone moves rows
        assert "customer_id" in line and "order_id" not in line.split("hashpartitioning")[1]
    assert rows_of(stored.int_orders) == rows_of(plain.int_orders)


def test_a_bucket_is_one_file(spark):
    name, path = f"bucketed_{uuid.uuid4().hex[:8]}", fresh_path(spark, "bucketed")
    rows = spark.range(2000).selectExpr("id % 500 AS order_id", "id AS x").repartition(9)
    assert tables.write_table(rows, name, path, bucket_by=(4, "order_id")) == 2000
    assert len(list(Path(path.removeprefix("file:")).glob("part-*.parquet"))) == 4
    assert spark.table(name).count() == 2000


# ---- months -------------------------------------------------------------------------------


ORDERS = """order_id long, order_status string, order_month timestamp_ntz, review_score int,
days_to_deliver long, delivered_on_time boolean, total_payment_value double,
has_review_comment boolean, used_voucher boolean, version int"""


def made(n=200):
    draw = random.Random(4)
    return [(i, draw.choice(["delivered", "shipped"]), dt.datetime(2020, 1 + i % 6, 1),
             draw.randrange(1, 6), draw.randrange(30), True, i * 0.37, False, None, 1)
            for i in range(n)]


def stamps(path):
    return {f.parent.name: (f.name, f.stat().st_mtime_ns)
            for f in Path(path.removeprefix("file:")).glob("month_key=*/*.parquet")}


def test_a_changed_month_rewrites_one_partition(spark):
    before = made()
    after = [r if r[0] != 8 else (*r[:1], "delivered", *r[2:6], 999.5, *r[7:9], 2) for r in before]
    old, new = (spark.createDataFrame(rows, ORDERS) for rows in (before, after))
    path = fresh_path(spark, "months")
    months.build(old, path)
    first = stamps(path)
    changed = months.changed_months(old, new, "version")
    assert changed == [dt.datetime(2020, 3, 1)]
    months.refresh(new, path, changed)
    second = stamps(path)
    assert {k for k in first if first[k] != second[k]} == {"month_key=2020-03"}
    assert rows_of(months.indicators(spark, path)) == rows_of(kpis.monthly(new))
    assert rows_of(kpis.monthly(new)) != rows_of(kpis.monthly(old))


def test_orders_that_move_come_and_go(spark):
    before = made()
    # one order moves to a month of its own, one month loses all orders, one order is new
    after = [(*r[:2], dt.datetime(2021, 1, 1), *r[3:]) if r[0] == 7 else r
             for r in before if r[2].month != 5]
    after.append((9999, "delivered", dt.datetime(2020, 1, 1), None, None, None, None, True, True, 1))
    old, new = (spark.createDataFrame(rows, ORDERS) for rows in (before, after))
    path = fresh_path(spark, "months")
    months.build(old, path)
    changed = months.changed_months(old, new, "version")
    assert sorted((m.year, m.month) for m in changed) == [(2020, 1), (2020, 2), (2020, 5), (2021, 1)]
    months.refresh(new, path, changed)
    assert rows_of(months.indicators(spark, path)) == rows_of(kpis.monthly(new))
    months.refresh(new, path, [])
    assert rows_of(months.indicators(spark, path)) == rows_of(kpis.monthly(new))


# ---- checks -------------------------------------------------------------------------------


CHECKED = quality.Checks("t", ("k", "m"), ("k", "m", "v"), {"v": ("a", "b")})


def checked(spark, rows):
    return spark.createDataFrame(rows, "k string, m long, v string")


def test_all_tests_of_a_table_in_one_scan(spark):
    rows = [("x", 1, "a"), ("x", 2, "c"), ("x", None, None), (None, None, "b"), ("y", 2, "a"), ("z", 3, "q")]
    df = checked(spark, rows)
    plan = quality.first_pass(df, CHECKED)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    found = {(r.column_name, r.test): (r.failures, r.passed)
             for r in quality.report({"t": df}, [CHECKED]).collect()}
    assert found == {
        ("k", "unique"): (1, False), ("k", "not_null"): (1, False), ("m", "unique"): (1, False),
        ("m", "not_null"): (2, False), ("v", "not_null"): (1, False),
        ("v", "accepted_values"): (2, False),
    }


def test_clean_keys_are_not_looked_at_again(spark, monkeypatch):
    monkeypatch.setattr(quality, "repeated_values", lambda *a: pytest.fail("looked again"))
    df = checked(spark, [(str(i), i, "a") for i in range(50)])
    assert quality.report({"t": df}, [CHECKED]).where("NOT passed").count() == 0
    assert quality.report({"t": df.limit(0)}, [CHECKED]).where("NOT passed").count() == 0


def test_equal_hashes_are_not_taken_for_equal_values(spark, monkeypatch):
    """With a hash of one bit every key is a suspect; the counts stay exact."""
    real = F.xxhash64
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(2)))
    rows = [(str(i), i, "a") for i in range(20)] + [("3", 40, "a"), ("4", 41, "a")]
    found = {(r.column_name, r.test): r.failures
             for r in quality.report({"t": checked(spark, rows)}, [CHECKED]).collect()}
    assert found["k", "unique"] == 2 and found["m", "unique"] == 0


def test_every_declared_table_is_read_once(spark, small_folder):
    shop = Shop.over_fixtures(spark, small_folder)
    for checks in quality.SOURCE_CHECKS:
        name = checks.table.removeprefix("src_")
        schema = shop.src[name].schema
        path = fresh_path(spark, name)
        shop.src[name].write.parquet(path)
        stored = spark.read.schema(schema).parquet(path)
        plan = quality.first_pass(stored, checks)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("FileScan") == 1, checks.table


def test_buckets_follow_the_rows(spark):
    few, many = spark.range(10), spark.range(250)
    assert tables.buckets_for({"orders": few, "order_items": many, "sellers": spark.range(900)}, 20) == 13
    assert tables.buckets_for({"orders": few}, 20) == tables.LEAST_BUCKETS
    assert tables.buckets_for({}) == tables.LEAST_BUCKETS
