"""Models on small hand-made sources with every awkward case."""

import datetime as dt

import pytest
from orderloom.functions.masking import default_masks
from orderloom.operators import churn, customers, geography, kpis, orders, serving, showcase
from orderloom.plans.shop import Shop
from orderloom.sources import schemas

from conftest import values

T0 = dt.datetime(2018, 1, 10, 12)
day = dt.timedelta(days=1)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, schemas.struct(schemas.SOURCES[name]))


@pytest.fixture(scope="module")
def shop(spark):
    order = lambda o, status, bought, delivered, due: (
        o, f"c_{o}", status, bought, bought, None, delivered, due)
    placed = [
        order("o1", "delivered", T0, T0 + 5 * day, T0 + 10 * day),
        order("o2", "delivered", T0 + 40 * day, None, T0 + 50 * day),   # delivered, no date
        order("o3", "canceled", T0 + 60 * day, None, T0 + 70 * day),
        order("o4", "delivered", T0 + 2 * day, T0 + 30 * day, T0 + 9 * day),  # late, no payment
        order("o5", "delivered", T0 + 300 * day, T0 + 303 * day, T0 + 310 * day),
    ]
    people = [
        ("c_o1", "p1", 1, "lima", "SP"), ("c_o2", "p1", 2, "rio", "RJ"),
        ("c_o3", "p1", 2, "rio", "RJ"), ("c_o4", "p2", 1, "lima", "SP"),
        ("c_o5", "p3", 9, "nowhere", "AM"), ("c_none", "p4", 1, "lima", "SP"),  # no order
    ]
    items = [
        ("o1", 1, "a", "s1", T0, 10.0, 1.5), ("o1", 2, "a", "s2", T0, 20.0, 2.5),
        ("o2", 1, "b", "s1", T0, 5.0, 0.5), ("o5", 1, "x", "s1", T0, 7.0, 0.1),
    ]
    payments = [
        ("o1", 1, "boleto", 1, 17.0), ("o1", 2, "voucher", 1, 17.0),     # equal values
        ("o2", 1, "not_defined", 1, 5.5), ("o3", 1, "credit_card", 3, 8.0),
        ("o5", 1, "not_defined", 1, 1.0), ("o5", 2, "debit_card", 1, 6.1),
    ]
    reviews = [
        ("r1", "o1", 2, None, "bad", T0 + 6 * day, T0 + 7 * day),
        ("r2", "o1", 5, None, 'fine, "really"\nyes', T0 + 6 * day, T0 + 7 * day),  # same time
        ("r3", "o4", 1, None, "", T0 + 31 * day, T0 + 32 * day),
        ("r4", "o5", 4, None, None, T0 + 305 * day, T0 + 306 * day),
    ]
    products = [("a", "cama", 1, 1, 1, 1.0, 1.0, 1.0, 1.0), ("b", None, 1, 1, 1, 1.0, 1.0, 1.0, 1.0),
                ("x", "novo", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)]
    geo = [(1, -10.0, -40.0, "lima", "SP"), (1, -12.0, -42.0, "lima", "SP"),
           (3, -20.0, -50.0, "lima", "SP"), (2, -5.0, -30.0, "rio", "RJ")]
    data = {
        "orders": placed, "customers": people, "order_items": items, "order_payments": payments,
        "order_reviews": reviews, "products": products, "sellers": [("s1", 1, "lima", "SP")],
        "geolocation": geo, "category_translation": [("cama", "bed")],
    }
    sources = {name: frame(spark, name, rows) for name, rows in data.items()}
    sources["churn_predictions"] = spark.createDataFrame(
        [("p1", 0.9, 1, "m", "2018-10-17 00:00:00"), ("p9", 0.1, 0, "m", "2018-10-17 00:00:00")],
        schemas.struct(schemas.CHURN_PREDICTIONS))
    return Shop(sources)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_payments_per_order(shop):
    rows = by(shop.stg_order_payments, "order_id")
    assert rows["o1"].primary_payment_type == "voucher" and rows["o1"].total_payment_value == 34.0
    assert rows["o1"].payment_installments_total == 2 and rows["o1"].used_boleto
    assert not rows["o1"].used_credit_card
    silver = by(orders.payments_first_kind(shop.src["order_payments"]), "order_id")
    assert silver["o2"].primary_payment_type is None
    assert silver["o5"].primary_payment_type == "debit_card"


def test_enriched_orders(shop):
    rows = by(shop.int_orders, "order_id")
    assert len(rows) == 5
    assert rows["o1"].review_score == 5 and rows["o1"].has_review_comment  # tie by review id
    assert rows["o1"].days_to_deliver == 5 and rows["o1"].delivery_delta_days == -5
    assert rows["o1"].delivered_on_time is True and rows["o4"].delivered_on_time is False
    assert rows["o2"].delivered_on_time is None and rows["o2"].has_review_comment is False
    assert rows["o4"].total_payment_value is None and rows["o4"].has_review_comment is False


def test_person_history_and_dimension(shop):
    rows = by(shop.dim_customers, "customer_unique_id")
    p1, p4 = rows["p1"], rows["p4"]
    assert (p1.state, p1.city, p1.total_orders, p1.canceled_orders) == ("RJ", "rio", 3, 1)
    assert p1.total_spend_brl == 47.5 and p1.avg_order_value_brl == 15.83
    assert p1.customer_lifespan_days == 60 and p1.on_time_deliveries == 1
    assert (p4.state, p4.total_orders, p4.order_frequency_segment) == (None, 0, "loyal")
    assert p4.satisfaction_segment == "dissatisfied" and p4.total_spend_brl is None
    assert rows["p2"].lat == -15.5  # mean of the zip means -11 and -20
    assert rows["p3"].lat is None
    assert set(by(shop.silver_customers, "customer_unique_id")) == {"p1", "p2", "p3"}


def test_city_means_differ_by_weighting(shop):
    raw = by(geography.city_centroids_by_point(shop.src["geolocation"]), "city")
    assert raw["lima"].lat == -14.0


def test_fact_key_equals_dimension_lookup(shop):
    looked_up = orders.fact(
        shop.int_orders, shop.stg_customers, shop.stg_order_items, shop.dim_customers)
    assert sorted(values(shop.fct_orders)) == sorted(values(looked_up))
    row = by(shop.fct_orders, "order_id")["o1"]
    assert (row.item_count, row.distinct_products, row.distinct_sellers) == (2, 1, 2)
    assert row.items_subtotal_brl == 30.0 and row.freight_total_brl == 4.0


def test_monthly(shop):
    rows = {r.order_month.strftime("%Y-%m"): r for r in shop.kpi_monthly.collect()}
    jan, feb = rows["2018-01"], rows["2018-02"]
    assert (jan.total_orders, jan.csat_rate, jan.on_time_rate) == (2, 0.5, 0.5)
    assert feb.csat_rate is None and feb.on_time_rate == 0.0  # no review: guarded
    gold = {r.order_month.strftime("%Y-%m"): r for r in shop.gold_monthly_kpis.collect()}
    assert gold["2018-02"].on_time_rate is None


def test_monthly_range_rejects_bad_windows(shop):
    got = serving.monthly_range(shop.kpi_monthly, "2018-02-01", "2018-12-31")
    assert got.count() == 2
    for window in (("2018-02-01", "2018-01-01"), ("2018-2-1", "2018-12-31")):
        with pytest.raises(ValueError):
            serving.monthly_range(shop.kpi_monthly, *window)


def test_delivery_performance_arguments(shop):
    by_state = serving.delivery_performance(shop.fct_orders, shop.dim_customers, "state", 1)
    assert {r.dimension: r.total_orders for r in by_state.collect()} == {"RJ": 2, "SP": 1, "AM": 1}
    for bad in ({"group_by": "order_id"}, {"sort_by": "order_id"}):
        with pytest.raises(ValueError):
            serving.delivery_performance(shop.fct_orders, shop.dim_customers, **bad)


def test_segment_query_masks_and_never_interprets_values(shop):
    masks = default_masks("s")
    rows = serving.customer_segments(shop.dim_customers, masks, state="rj").collect()
    assert [r.state for r in rows] == ["RJ"] and rows[0].customer_unique_id.startswith("cust_")
    attack = serving.customer_segments(shop.dim_customers, masks, state="RJ' OR '1'='1")
    assert attack.count() == 0
    assert serving.limit_rows(10_000) == 500


def test_run_sql_reads_only(spark, shop):
    shop.dim_customers.createOrReplaceTempView("people_view")
    ok = serving.run_sql(spark, "WITH x AS (SELECT state FROM people_view) SELECT * FROM x;")
    assert ok.count() == 4
    for bad in ("DROP VIEW people_view", "SELECT 1; DROP VIEW people_view", "",
                "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x",
                "SELECT 1) q; DROP VIEW people_view --",
                "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
                "SELECT 1 WHERE EXISTS (SELECT java_method('java.util.UUID', 'randomUUID'))",
                "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`",
                "WITH x AS (SELECT * FROM csv.`/etc/hosts`) SELECT * FROM x"):
        with pytest.raises(Exception):
            serving.run_sql(spark, bad).collect()
    assert spark.catalog.tableExists("people_view")


def test_churn_features(shop):
    rows = by(shop.churn_features, "customer_unique_id")
    assert set(rows) == {"p1", "p2"}  # p3 is the newest buyer, p4 never bought
    p2 = rows["p2"]
    assert p2.is_churned == 1 and p2.primary_payment_type == "unknown"
    assert p2.avg_item_count == 1.0 and p2.has_low_review == 1 and p2.had_late_delivery == 1
    assert rows["p1"].avg_freight_brl == 2.25
    strict = churn.features(shop.fct_orders, shop.dim_customers, 240, inclusive=False)
    assert by(strict, "customer_unique_id")["p1"].is_churned == 0


def test_score_mart_keeps_unknown_people(shop):
    rows = by(shop.mart_churn, "customer_unique_id")
    assert rows["p9"].churn_risk_tier == "low" and rows["p9"].total_orders is None
    assert rows["p1"].churn_risk_tier == "critical"


def test_cohorts(shop):
    got = values(showcase.cohort_retention(shop.fct_orders, 1).select(
        "cohort_size", "returned_customers", "retention_pct"))
    assert got == [(2, 1, 50.0), (1, 0, 0.0)]


def test_products_keep_untranslated_names(shop):
    rows = by(shop.stg_products, "product_id")
    assert [rows[p].category_name_en for p in "abx"] == ["bed", None, "novo"]


def test_empty_inputs(spark, shop):
    empty = Shop({name: df.limit(0) for name, df in shop.src.items()})
    for model in ("dim_customers", "fct_orders", "kpi_monthly", "churn_features", "mart_churn",
                  "silver_customers", "gold_customer_segments"):
        assert getattr(empty, model).count() == 0
    assert kpis.header(empty.kpi_monthly).first().total_orders is None


def test_order_history_counts_orders_once_per_account_row(shop):
    hot = shop.int_orders.unionByName(shop.int_orders.where("order_id = 'o1'"))
    rows = by(customers.order_history(shop.stg_customers, hot), "customer_unique_id")
    assert rows["p1"].total_orders == 4


def test_slowest_sellers_keep_ties(spark):
    perf = spark.createDataFrame(
        [(f"s{i}", "c", 20, d, 3.0, 50.0) for i, d in enumerate([9.0, 9.0, 7.0, 7.0, 5.0, 1.0])],
        "seller_id string, category_en string, orders bigint, avg_delivery_days double, "
        "avg_review double, on_time_pct double")
    got = values(showcase.seller_ranking(perf, 3).select(
        "seller_id", "delivery_rank_in_category", "days_above_category_median",
        "sellers_in_category", "performance_flag"))
    assert [(g[0], g[1]) for g in got] == [("s0", 1), ("s1", 1), ("s2", 3), ("s3", 3)]
    assert got[0][2:] == (2.0, 6, "Watch: above category average")
    single = perf.limit(1)
    assert values(showcase.seller_ranking(single).select("days_above_category_median")) == [(0.0,)]
