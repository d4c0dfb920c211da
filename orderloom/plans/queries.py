"""Named queries: one per operator, each over the whole tables it reads."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates, keys, masking, segments, text
from ..functions.numeric import exact_mean, exact_sum, percent, ratio, rounded
from ..operators import (
    audit, churn, customers, geography, kpis, ml, orders, quality, ranking, serving, showcase,
    stats,
)
from ..session import fresh_path, handed_over, remove
from ..sources import files, inference, quoted, schemas, tables
from ..streaming import audit_live, kpi_live
from . import build, months
from .shop import MODELS, Shop

Build = Callable[[Shop], DataFrame]
REGISTRY: dict[str, Build] = {}

#: The supplied tables cover 1995 to 2001, so date windows are set to that span.
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
RECENT = dt.datetime(1998, 1, 1)
DEMO_SECRET = "demo-secret-for-checks"
TODAY = "2001-08-31"


def query(name: str) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        REGISTRY[name] = build
        return build
    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Build):
        return lambda spark, folder: build(Shop.over_fixtures(spark, folder))
    return {name: bind(build) for name, build in REGISTRY.items()}


def _spark(s: Shop) -> SparkSession:
    return s.src.spark


# ---- sources and models -------------------------------------------------------------------

for _source in (*schemas.SOURCES, "churn_predictions"):
    REGISTRY[f"src_{_source}"] = lambda s, name=_source: s.src[name]

for _model in (*MODELS, "silver_orders", "silver_customers", "silver_churn_features",
               "gold_monthly_kpis", "gold_customer_segments"):
    REGISTRY[_model] = lambda s, name=_model: getattr(s, name)

REGISTRY["gold_delivery_by_state"] = lambda s: s.gold_delivery_by_state()


def _as_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


for _source in schemas.SOURCES:
    REGISTRY[f"bronze_{_source}"] = lambda s, name=_source: files.bronze_shape(name)(
        _as_text(s.src[name])
    )


@query("src_audit")
def _(s):
    return s.audit_log.drop("params")


# ---- reading and writing ------------------------------------------------------------------


def _csv_copy(s: Shop, source: str) -> tuple[str, str]:
    folder = fresh_path(_spark(s), "csv")
    files.write_csv(s.src[source], f"{folder}/{source}.csv")
    return folder, f"{source}.csv"


def _table_name(base: str) -> str:
    return f"{base}_{uuid.uuid4().hex[:12]}"


def _stored(s: Shop, df: DataFrame, base: str) -> str:
    name = _table_name(base)
    tables.write_table(df, name, fresh_path(_spark(s), base))
    return name


@query("ingest_csv")
def _(s):
    spark = _spark(s)
    folder, file_name = _csv_copy(s, "order_reviews")
    name = _table_name("raw_order_reviews")
    files.ingest_csv(
        spark, folder, file_name, schemas.ORDER_REVIEWS, name,
        files.bronze_shape("order_reviews"), fresh_path(spark, "bronze"), multi_line=True,
    )
    return spark.table(name).drop("_ingested_at")


def _layers(s: Shop, last: str = "gold") -> dict[str, str]:
    """All sources as CSV files, through the stored layers up to ``last``; the schema of each layer.

    The files are packed, and each is dropped once its bronze table is stored.
    """
    spark = _spark(s)
    folder = fresh_path(spark, "csv")
    names = {source: f"{source}.csv" for source in schemas.SOURCES}
    build.side_by_side([
        partial(files.write_csv, s.src[source], f"{folder}/{file_name}", **files.PACKED)
        for source, file_name in names.items()
    ])
    layers = {layer: _table_name(layer) for layer in ("bronze", "silver", "gold")}
    build.build_layers(spark, folder, names, layers, fresh_path(spark, "layers"), last=last,
                       ingested=lambda source: remove(spark, f"{folder}/{names[source]}"))
    return layers


@query("stored_bronze")
def _(s):
    return _spark(s).table(f"{_layers(s, 'bronze')['bronze']}.raw_order_payments").drop(
        "_ingested_at", "_source_file")


@query("stored_silver")
def _(s):
    return _spark(s).table(f"{_layers(s, 'silver')['silver']}.silver_customers").drop("_transformed_at")


@query("stored_gold")
def _(s):
    return _spark(s).table(f"{_layers(s)['gold']}.gold_customer_segments").drop("_updated_at")


@query("stored_marts")
def _(s):
    schema = _table_name("marts")
    build.build_marts(_spark(s), s, schema, fresh_path(_spark(s), "marts"))
    return _spark(s).table(f"{schema}.fct_orders")


@query("scan_csv_inferred")
def _(s):
    """Payments as their values say, and the types that were found."""
    folder, file_name = _csv_copy(s, "order_payments")
    found = files.read_csv_inferred(_spark(s), f"{folder}/{file_name}")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return found.withColumn("types", F.lit(types))


@query("inferred_types")
def _(s):
    """Types of all nine files, and of payments with an odd last row, in one job."""
    spark = _spark(s)
    copies = {source: "/".join(_csv_copy(s, source)) for source in schemas.SOURCES}
    odd, _ = _csv_copy(s, "order_payments")
    last = s.src["order_payments"].limit(1).select(
        "order_id", "payment_sequential", "payment_type", F.lit("none").alias("payment_installments"),
        "payment_value")
    last.write.options(header=True).csv(f"{odd}/order_payments.csv/odd")
    copies["odd_payments"] = f"{odd}/order_payments.csv"
    texts = {}
    for source, path in copies.items():
        header = inference.header_schema(
            spark, path if source != "odd_payments" else copies["order_payments"])
        if source == "order_reviews":
            texts[source] = quoted.read(spark, path, header)
        else:
            texts[source] = spark.read.schema(header).options(
                header=True, recursiveFileLookup=True).csv(path)
    return inference.column_types(texts)


@query("scan_csv_declared")
def _(s):
    folder, file_name = _csv_copy(s, "churn_predictions")
    return files.read_predictions(_spark(s), f"{folder}/{file_name}")


@query("scan_table")
def _(s):
    return tables.table(_spark(s), _stored(s, s.src["sellers"], "sellers"))


@query("scan_jsonl_audit")
def _(s):
    path = fresh_path(_spark(s), "audit")
    files.append_audit(s.audit_log, path)
    log = files.read_audit_log(_spark(s), path)
    return log.select(
        "timestamp", "level", "session", "function", "row_count", "duration_ms", "status",
        F.element_at("params", "k").alias("k"),
    )


@query("write_audit_event")
def _(s):
    path = fresh_path(_spark(s), "audit")
    for status in ("success", "error"):
        files.append_audit(s.audit_log.where(F.col("status") == status), path)
    return files.read_audit_log(_spark(s), path).groupBy("status", "level").agg(
        F.count("*").alias("events"), F.sum("row_count").alias("rows_returned")
    )


@query("add_lineage_cols")
def _(s):
    stamped = files.with_lineage(s.src["sellers"], "sellers.csv")
    return stamped.withColumn("stamped", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@query("write_table")
def _(s):
    name = _stored(s, s.stg_orders, "orders")
    tables.write_table(s.stg_customers, name, fresh_path(_spark(s), "replaced"))
    return _spark(s).table(name)


@query("write_count")
def _(s):
    spark = _spark(s)
    name = _table_name("counted")
    written = tables.write_table(s.int_orders, name, fresh_path(spark, "counted"))
    return spark.table(name).agg(F.count("*").alias("rows_read")).withColumn(
        "rows_written", F.lit(written).cast("bigint")
    )


@query("compat_views")
def _(s):
    """All nine sources through bronze and back, as one list of row counts and columns."""
    counted = None
    for source in schemas.SOURCES:
        view = tables.renamed_view(
            files.with_lineage(s.bronze(source)), files.restored_names(source), _table_name(source)
        )
        one = view.agg(F.count("*").alias("n_rows")).select(
            F.lit(source).alias("source"), "n_rows",
            F.lit(",".join(view.columns)).alias("columns"),
        )
        counted = one if counted is None else counted.unionAll(one)
    return counted


def _demo_schema(s: Shop) -> str:
    spark = _spark(s)
    schema = _table_name("demo")
    tables.create_schema(spark, schema, fresh_path(spark, "schema"))
    for model in ("kpi_monthly", "int_customer_orders"):
        tables.write_table(getattr(s, model), f"{schema}.{model}")
    return schema


@query("create_schema")
def _(s):
    return tables.table(_spark(s), "kpi_monthly", _demo_schema(s))


@query("list_tables")
def _(s):
    """Tables of a new schema with their columns, next to their row counts."""
    spark, schema = _spark(s), _demo_schema(s)
    counts = [
        spark.table(f"{schema}.{model}").agg(F.count("*").alias("n_rows"))
        .select(F.lit(model).alias("table_name"), "n_rows")
        for model in ("kpi_monthly", "int_customer_orders")
    ]
    listed = tables.list_tables(spark, schema)
    return listed.join(counts[0].unionAll(counts[1]), "table_name")


@query("materialise_view")
def _(s):
    view = _table_name("stg_customers")
    tables.publish_view(s.stg_customers, view)
    return _spark(s).table(view)


@query("materialise_table")
def _(s):
    name = _table_name("fct_orders")
    tables.write_table(
        s.fct_orders, name, fresh_path(_spark(s), "fct"), bucket_by=(8, "order_id")
    )
    return _spark(s).table(name).groupBy("order_status").agg(
        F.count("*").alias("orders"), exact_sum("total_payment_value").alias("paid")
    )


def _by_order(s: Shop) -> Shop:
    """A shop over stored sources, those with rows per order bucketed alike."""
    spark, schema = _spark(s), _table_name("by_order")
    tables.create_schema(spark, schema)
    wanted = {name: s.src[name] for name in schemas.SOURCES}
    tables.store_by_order(wanted, schema, folder=fresh_path(spark, "by-order"))
    return Shop.over_tables(spark, schema)


@query("join_order_payment_review_bucketed")
def _(s):
    """As ``join_order_payment_review``, over stored tables that meet bucket by bucket."""
    return _by_order(s).int_orders.select(
        "order_id", "total_payment_value", "primary_payment_type", "review_score",
        "has_review_comment",
    )


@query("join_fact_star_bucketed")
def _(s):
    return _by_order(s).fct_orders.select(
        "order_id", "customer_unique_id", "customer_sk", "item_count", "items_subtotal_brl"
    )


@query("kpi_monthly_refreshed")
def _(s):
    """Monthly sums of an earlier state, in which of the orders since 1998 every fifth was still
    on its way and every seventh had not come yet; then the changed months are rebuilt."""
    spark = _spark(s)
    now = handed_over(s.dated_orders.select(
        "order_id", "order_status", "order_month", "review_score", "days_to_deliver",
        "delivered_on_time", "total_payment_value", "has_review_comment", "used_voucher",
    ), "orders")
    recent = F.col("order_month") >= F.lit(RECENT)
    earlier = handed_over(
        now.where(~recent | (F.col("order_id") % 7 != 0)).withColumn(
            "order_status",
            F.when(recent & (F.col("order_id") % 5 == 0), "shipped").otherwise(F.col("order_status"))),
        "earlier",
    )
    path = fresh_path(spark, "monthly-sums")
    months.build(earlier, path)
    months.refresh(now, path, months.changed_months(earlier, now, "order_status"))
    return months.indicators(spark, path)


@query("write_predictions")
def _(s):
    path = fresh_path(_spark(s), "predictions")
    files.write_csv(s.src["churn_predictions"], path)
    return churn.tiered(files.read_predictions(_spark(s), path))


@query("rows_out")
def _(s):
    return s.kpi_monthly.orderBy("order_month")


# ---- projections and filters --------------------------------------------------------------


@query("surrogate_key")
def _(s):
    return s.src["products"].select(
        "product_id",
        keys.surrogate_key("product_id", "product_category_name").alias("product_sk"),
    )


def _status_count(df: DataFrame) -> DataFrame:
    return df.groupBy("order_status").agg(
        F.count("*").alias("n"), F.max("purchased_at").alias("newest")
    )


@query("filter_status_eq")
def _(s):
    return _status_count(kpis.with_status(s.stg_orders, kpis.DELIVERED))


@query("filter_status_in")
def _(s):
    return _status_count(kpis.with_status(s.stg_orders, *segments.RETAINED_STATUSES))


@query("filter_not_null")
def _(s):
    return s.int_orders.where(
        F.col("days_to_deliver").isNotNull() & F.col("review_score").isNotNull()
    ).select("order_id", "days_to_deliver", "review_score")


@query("filter_nonneg")
def _(s):
    return stats.rated_deliveries(s.int_orders)


@query("filter_spend_pos")
def _(s):
    spend = F.col("total_spend_brl")
    return s.dim_customers.agg(
        F.count_if(spend > 0).alias("spenders"), F.count_if(spend >= 100).alias("worth_keeping")
    )


@query("filter_month_between")
def _(s):
    return serving.monthly_range(
        s.kpi_monthly, "1996-03-01", "1997-02-28", FIRST_DAY, LAST_DAY
    ).select("order_month", "total_orders")


@query("filter_tenure")
def _(s):
    return s.churn_features.select("customer_unique_id", "days_since_first_order")


@query("has_comment")
def _(s):
    return s.stg_order_reviews.select(
        "review_id", text.has_text("comment_message").alias("has_review_comment")
    )


@query("delivered_on_time")
def _(s):
    return s.stg_orders.select(
        "order_id",
        orders.delivered_on_time("customer_delivered_at", "estimated_delivery_at")
        .alias("delivered_on_time"),
    )


@query("bool_to_int")
def _(s):
    return s.churn_features.select(
        "customer_unique_id", "has_low_review", "had_late_delivery", "used_voucher_ever",
        "used_credit_card_ever",
    )


@query("default_nulls")
def _(s):
    return s.churn_features.select(
        "customer_unique_id", "cancel_rate", "avg_freight_brl", "avg_review_score",
        "avg_days_to_deliver", "primary_payment_type", "avg_item_count",
    )


def _people_by(s: Shop, label: Column, name: str) -> DataFrame:
    return s.dim_customers.groupBy(label.alias(name)).agg(F.count("*").alias("customers"))


@query("seg_frequency")
def _(s):
    return _people_by(s, segments.frequency_segment("total_orders"), "segment")


@query("seg_satisfaction")
def _(s):
    return _people_by(s, segments.satisfaction_segment("avg_review_score"), "segment")


@query("seg_risk_tier")
def _(s):
    return s.src["churn_predictions"].select(
        "customer_unique_id", segments.risk_tier("churn_probability").alias("tier")
    )


@query("seg_delivery_bucket")
def _(s):
    return s.int_orders.where("days_to_deliver IS NOT NULL").select(
        "order_id", segments.delivery_bucket("days_to_deliver").alias("bucket")
    )


@query("seg_spend_tier")
def _(s):
    tiled = ranking.ntile(
        s.dim_customers.where("total_spend_brl > 0")
        .select("customer_unique_id", "total_spend_brl"),
        "total_spend_brl", "customer_unique_id", 10, "decile",
    )
    return tiled.select("customer_unique_id", segments.spend_tier("decile").alias("tier"))


@query("seg_retention_label")
def _(s):
    return showcase.cohort_retention(s.fct_orders, 20).select("cohort_month", "retention_label")


@query("recommend_action")
def _(s):
    return s.mart_churn.select(
        "customer_unique_id",
        segments.recommended_action("churn_risk_tier", "satisfaction_segment").alias("action"),
    )


@query("weight_by_segment")
def _(s):
    return s.dim_customers.select(
        "customer_unique_id", segments.loyalty_weight("order_frequency_segment").alias("weight")
    )


MASKS = masking.default_masks(DEMO_SECRET)


@query("customer_segments")
def _(s):
    return serving.customer_segments(
        s.dim_customers, MASKS, state="nation_3", frequency="loyal",
        satisfaction="dissatisfied", min_spend=1000, limit=40,
    )


@query("churn_risk")
def _(s):
    return serving.churn_risk(s.mart_churn, MASKS, tier="high", min_spend=500, limit=60)


@query("monthly_kpis_range")
def _(s):
    return serving.monthly_range(s.kpi_monthly, "1995-06-01", "1999-12-31", FIRST_DAY, LAST_DAY)


def _date_texts(s: Shop) -> DataFrame:
    """Date arguments as callers might write them, one per order."""
    day, k = F.col("purchased_at"), F.col("order_id")
    written = (
        F.when(k % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(k % 5 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(k % 5 == 2, F.concat(F.date_format(day, "yyyy-MM"), F.lit("-31")))
        .when(k % 5 == 3, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" OR 1=1")))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    return s.stg_orders.select("order_id", written.alias("written"))


@query("validate_date_col")
def _(s):
    return serving.check_dates(
        _date_texts(s), "written", dt.date(1996, 1, 1), dt.date(1999, 12, 31)
    )


@query("run_sql")
def _(s):
    view = tables.publish_view(s.dim_customers, _table_name("dim_customers"))
    name = _table_name("people")
    view.createOrReplaceTempView(name)
    return serving.run_sql(_spark(s), f"""
        WITH named AS (SELECT state, total_orders FROM {name} WHERE state IS NOT NULL)
        SELECT state, count(*) AS customers, sum(total_orders) AS orders
        FROM named GROUP BY state
    """)


@query("bind_params")
def _(s):
    name = _table_name("people")
    s.dim_customers.createOrReplaceTempView(name)
    return serving.run_sql(
        _spark(s),
        f"SELECT customer_unique_id, total_orders FROM {name} "
        "WHERE state = :state AND total_orders >= :least",
        {"state": "NATION_7", "least": 5},
    )


@query("project_monthly_view")
def _(s):
    return kpis.monthly_view(s.kpi_monthly)


@query("project_monthly_trend")
def _(s):
    return kpis.monthly_trend(s.gold_monthly_kpis)


@query("project_churn_view")
def _(s):
    return churn.score_listing(s.mart_churn)


@query("at_risk_list")
def _(s):
    return churn.at_risk(churn.score_listing(s.mart_churn))


@query("audit_filter")
def _(s):
    chosen = audit.narrowed(s.audit_log, ["click", "error"], ["success", "error"])
    return chosen.select("timestamp", "function", "status", "row_count")


# ---- joins --------------------------------------------------------------------------------


@query("join_order_payment_review")
def _(s):
    return s.int_orders.select(
        "order_id", "total_payment_value", "primary_payment_type", "review_score",
        "has_review_comment",
    )


@query("join_translation")
def _(s):
    return s.stg_products.select("product_id", "category_name_en", "category_name_pt")


@query("join_customer_orders_left")
def _(s):
    return customers.order_history(s.stg_customers, s.int_orders).select(
        "customer_unique_id", "state", "total_orders", "first_order_at"
    )


@query("join_orders_customer_left")
def _(s):
    return s.silver_customers.select("customer_unique_id", "total_orders", "last_order_at")


@query("join_fact_star")
def _(s):
    return s.fct_orders.select(
        "order_id", "customer_unique_id", "customer_sk", "item_count", "items_subtotal_brl"
    )


@query("join_geo_composite")
def _(s):
    return s.dim_customers.select("customer_unique_id", "city", "state", "lat", "lng")


@query("cross_reference_date")
def _(s):
    newest = churn.reference_date(s.fct_orders)
    return s.dim_customers.select(
        "customer_unique_id", "last_order_at", newest.alias("reference_date")
    )


@query("collect_reference_date")
def _(s):
    return s.silver_churn_features.select(
        "customer_unique_id", "days_since_last_order", "days_since_first_order"
    )


@query("join_churn_features")
def _(s):
    return s.churn_features.select(
        "customer_unique_id", "total_orders", "avg_item_count", "avg_distinct_sellers"
    )


@query("join_predictions")
def _(s):
    return s.mart_churn.select(
        "customer_unique_id", "churn_probability", "churn_risk_tier", "state", "total_orders"
    )


@query("join_predictions_inner")
def _(s):
    risk = churn.tiered(s.src["churn_predictions"])
    return risk.join(s.dim_customers, "customer_unique_id").select(
        "customer_unique_id", "churn_risk_tier", "city", "total_spend_brl"
    )


@query("join_seller_category")
def _(s):
    return showcase.seller_category_performance(
        s.dated_orders, s.stg_order_items, s.stg_products, 1
    )


@query("join_fact_dim_state")
def _(s):
    return kpis.by_dimension(s.fct_orders, "state", s.dim_customers)


@query("join_gold_state")
def _(s):
    return s.gold_delivery_by_state(min_orders=1)


@query("cohort_self_join")
def _(s):
    return showcase.cohort_retention(s.fct_orders, 1).select(
        "cohort_month", "cohort_size", "returned_customers"
    )


# ---- aggregations -------------------------------------------------------------------------

REGISTRY["agg_payments"] = lambda s: s.stg_order_payments
REGISTRY["agg_geo_zip"] = lambda s: s.stg_geolocation
REGISTRY["agg_geo_city"] = lambda s: geography.city_centroids(s.stg_geolocation)
REGISTRY["agg_geo_city_raw"] = lambda s: geography.city_centroids_by_point(s.src["geolocation"])
REGISTRY["agg_items"] = lambda s: orders.item_rollup(s.stg_order_items)
REGISTRY["agg_payments_silver"] = lambda s: orders.payments_first_kind(
    s.bronze("order_payments"))
REGISTRY["churn_order_aggs"] = lambda s: churn.order_signals(s.fct_orders)
REGISTRY["gold_monthly"] = lambda s: s.gold_monthly_kpis
REGISTRY["churn_features_silver"] = lambda s: s.silver_churn_features


@query("arg_max")
def _(s):
    """Dearest item of every seller."""
    return s.src["order_items"].groupBy("seller_id").agg(
        keys.value_at_max("product_id", "price", "order_id", "order_item_id").alias("product_id")
    )


@query("bool_or_agg")
def _(s):
    return s.src["order_payments"].groupBy("payment_installments").agg(
        keys.any_true(F.col("payment_value") > 99000).alias("any_large"),
        keys.any_true(F.col("payment_type") == "cash").alias("any_cash"),
    )


@query("any_value")
def _(s):
    return s.stg_geolocation.select("zip_code_prefix", "city", "state")


@query("cond_count")
def _(s):
    score = F.col("review_score")
    return s.int_orders.groupBy("order_status").agg(
        F.count_if("delivered_on_time").alias("on_time"),
        F.count_if(score == 1).alias("low_score"),
        F.count_if("used_voucher").alias("with_voucher"),
    )


@query("safe_ratio")
def _(s):
    return s.int_orders.groupBy("order_status").agg(
        rounded(ratio(F.count_if(F.col("review_score") >= 4), F.count("review_score")), 4)
        .alias("csat_rate")
    )


@query("unsafe_ratio")
def _(s):
    return s.gold_monthly_kpis.select("order_month", "csat_rate", "on_time_rate")


@query("count_distinct")
def _(s):
    return s.src["order_items"].groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("product_id").alias("products"),
    )


@query("delivery_performance")
def _(s):
    return serving.delivery_performance(s.fct_orders, s.dim_customers, "state")


for _dimension in ("order_day_of_week", "order_month", "primary_payment_type"):
    REGISTRY[f"delivery_performance_{_dimension}"] = lambda s, by=_dimension: (
        serving.delivery_performance(s.dated_orders, None, by, 50, 40)
    )


@query("delivery_by_state_dash")
def _(s):
    return kpis.state_dashboard(s.fct_orders, s.dim_customers)


@query("delivery_bucket_kpis")
def _(s):
    return kpis.bucketed(s.dated_orders)


@query("kpi_header")
def _(s):
    return kpis.header(s.kpi_monthly)


@query("kpi_header_weighted")
def _(s):
    return kpis.header(s.kpi_monthly, weighted=True)


@query("segment_breakdown")
def _(s):
    return kpis.segment_breakdown(s.gold_customer_segments)


@query("frequency_spend")
def _(s):
    return kpis.frequency_spend(s.dim_customers)


@query("state_avg_days")
def _(s):
    return kpis.state_mean_days(s.dim_customers)


@query("score_by_weekday")
def _(s):
    return kpis.score_by_weekday(s.dated_orders)


@query("cohort_spend")
def _(s):
    return kpis.cohort_spend(s.dim_customers)


@query("late_vs_ontime_csat")
def _(s):
    return kpis.late_versus_on_time(s.dated_orders)


@query("status_distribution")
def _(s):
    return kpis.status_distribution(s.bronze("orders"))


@query("class_balance")
def _(s):
    return kpis.class_balance(s.silver_churn_features, "churned")


@query("class_balance_90")
def _(s):
    return kpis.class_balance(s.churn_labels, "is_churned")


@query("delivery_sanity")
def _(s):
    return kpis.delivery_sanity(s.silver_orders)


@query("tier_counts")
def _(s):
    return churn.tier_counts(churn.tiered(s.src["churn_predictions"]))


@query("score_histogram")
def _(s):
    return churn.score_histogram(churn.score_listing(s.mart_churn))


@query("review_histogram")
def _(s):
    return stats.review_histogram(stats.rated_deliveries(s.int_orders))


@query("score_quartiles")
def _(s):
    return churn.score_quartiles(churn.score_listing(s.mart_churn), "freq_segment")


@query("payment_quartiles")
def _(s):
    """Payments by kind at full precision; one kind has about half of all rows."""
    return churn.score_quartiles(
        s.src["order_payments"], "payment_type", "payment_value", "payments")


@query("spend_quartiles_by_state")
def _(s):
    return churn.score_quartiles(s.dim_customers, "state", "total_spend_brl")


@query("score_quartiles_by_satisfaction")
def _(s):
    return churn.score_quartiles(churn.score_listing(s.mart_churn), "sat_segment")


@query("having_min")
def _(s):
    counted = s.stg_customers.groupBy("city", "state").agg(F.count("*").alias("accounts"))
    return kpis.at_least(counted, "accounts", 50)


@query("group_by_alias")
def _(s):
    bucket = segments.delivery_bucket("days_to_deliver").alias("delivery_bucket")
    return s.int_orders.groupBy(bucket).agg(F.count("*").alias("orders"))


# ---- windows ------------------------------------------------------------------------------


@query("mom_delta")
def _(s):
    return showcase.month_over_month(s.kpi_monthly)


@query("running_totals")
def _(s):
    return showcase.running(s.kpi_monthly).select(
        "month", "total_orders", "gmv_k_brl", "cumulative_orders", "cumulative_gmv_k_brl"
    )


@query("running_weighted_avg")
def _(s):
    return showcase.running(s.kpi_monthly).select("month", "running_avg_review")


def _spenders(s: Shop) -> DataFrame:
    return s.dim_customers.where("total_spend_brl > 0").select(
        "customer_unique_id", "state", "total_spend_brl"
    )


@query("spend_ntile")
def _(s):
    return ranking.ntile(
        _spenders(s), "total_spend_brl", "customer_unique_id", 10, "spend_decile"
    )


@query("spend_percent_rank")
def _(s):
    return ranking.percent_rank(handed_over(_spenders(s)), "total_spend_brl", "spend_percentile")


@query("rank_in_state")
def _(s):
    return ranking.rank_within(handed_over(_spenders(s)), ["state"], "total_spend_brl", "rank_in_state")


@query("top_decile_customers")
def _(s):
    return showcase.top_decile_spenders(s.dim_customers)


@query("latest_review")
def _(s):
    return orders.latest_review(s.stg_order_reviews)


@query("latest_address")
def _(s):
    return customers.latest_address(s.stg_customers, s.int_orders)


@query("order_sequence")
def _(s):
    placed = kpis.with_status(s.fct_orders, *segments.RETAINED_STATUSES).select(
        "customer_unique_id", "order_id", "purchased_at"
    )
    return ranking.number_within(
        placed, ["customer_unique_id"], ["purchased_at", "order_id"], "order_rank"
    )


@query("max_over_all")
def _(s):
    people = s.dim_customers.select("customer_unique_id", "total_spend_brl")
    highest = people.agg(F.max("total_spend_brl")).scalar()
    return people.withColumn("highest_spend", highest)


@query("share_of_total")
def _(s):
    counted = s.bronze("orders").groupBy("order_status").agg(F.count("*").alias("n"))
    return kpis.share_of_total(counted, "n", "pct", 2)


def _performance(s: Shop, min_orders: int = 20) -> DataFrame:
    return showcase.seller_category_performance(
        s.dated_orders, s.stg_order_items, s.stg_products, min_orders
    )


@query("category_median_gap")
def _(s):
    return showcase.category_places(_performance(s)).select(
        "category_en", "avg_delivery_days", "days_above_category_median"
    )


@query("category_size")
def _(s):
    return showcase.category_places(_performance(s)).select(
        "category_en", "avg_delivery_days", "sellers_in_category"
    )


@query("seller_ranking")
def _(s):
    return showcase.seller_ranking(_performance(s))


@query("seller_flag")
def _(s):
    return showcase.seller_ranking(_performance(s), None).select(
        "seller_id", "category_en", "performance_flag"
    )


@query("cohort_retention")
def _(s):
    return showcase.cohort_retention(s.fct_orders, 50)


# ---- sorting and limiting -----------------------------------------------------------------


@query("sort_month")
def _(s):
    return s.kpi_monthly.select("order_month", "total_orders").orderBy("order_month")


@query("topk_spend")
def _(s):
    return serving.customer_segments(s.dim_customers, {}, limit=100).select(
        "customer_unique_id", "total_spend_brl"
    )


@query("topk_priority")
def _(s):
    return showcase.retention_priority(
        churn.tiered(s.src["churn_predictions"]), s.dim_customers, TODAY
    ).select("customer_unique_id", "priority_score")


@query("topk_churn")
def _(s):
    return serving.churn_risk(s.mart_churn, {}, limit=25)


@query("worst_states")
def _(s):
    return kpis.worst_states(s.gold_delivery_by_state())


@query("worst_on_time")
def _(s):
    return serving.delivery_performance(
        s.fct_orders, s.dim_customers, "state", 100, 10, "on_time_pct", ascending=True
    )


@query("topk_per_group")
def _(s):
    return showcase.seller_ranking(_performance(s)).select(
        "category_en", "seller_id", "delivery_rank_in_category"
    )


@query("dynamic_sort")
def _(s):
    return serving.sorted_states(
        kpis.state_dashboard(s.fct_orders, s.dim_customers), "csat_pct"
    )


@query("limit_clamp")
def _(s):
    return serving.customer_segments(s.dim_customers, {}, limit=100_000).select(
        "customer_unique_id", "total_orders"
    )


# ---- set operations -----------------------------------------------------------------------


@query("distinct_rows")
def _(s):
    return s.stg_customers.select("city", "state").distinct()


@query("distinct_on")
def _(s):
    return orders.latest_review(
        s.stg_order_reviews, ("review_score", "review_created_at")
    )


# ---- scalar functions ---------------------------------------------------------------------


@query("fn_cast_ts")
def _(s):
    raw = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    spoiled = F.when(F.col("order_id") % 10 == 0, "unknown").otherwise(raw)
    return s.src["orders"].select(
        "order_id", spoiled.try_cast("timestamp_ntz").alias("purchased_at")
    )


@query("fn_cast_date")
def _(s):
    return s.stg_orders.select("order_id", dates.date_of("purchased_at").alias("day"))


@query("fn_days_between")
def _(s):
    return s.stg_orders.select(
        "order_id",
        dates.days_between("purchased_at", "customer_delivered_at").alias("days_to_deliver"),
        dates.days_between("estimated_delivery_at", "customer_delivered_at").alias("delta"),
    )


@query("fn_hours_between")
def _(s):
    return s.stg_orders.select(
        "order_id", dates.hours_between("purchased_at", "approved_at").alias("hours")
    )


@query("fn_month_trunc")
def _(s):
    return s.stg_orders.groupBy(dates.month_start("purchased_at").alias("order_month")).agg(
        F.count("*").alias("n"))


@query("fn_week_trunc")
def _(s):
    return s.stg_orders.groupBy(dates.week_start("purchased_at").alias("order_week")).agg(
        F.count("*").alias("n"))


@query("fn_day_of_week")
def _(s):
    return s.stg_orders.groupBy(dates.weekday("purchased_at").alias("day_of_week")).agg(
        F.count("*").alias("n"))


@query("fn_days_since_ref")
def _(s):
    today = F.lit(TODAY).cast("date")
    return s.stg_orders.select(
        "order_id", dates.days_between("purchased_at", today).alias("days_inactive")
    )


@query("fn_interval_minus")
def _(s):
    return s.stg_orders.select(
        "order_id", dates.days_earlier("purchased_at", 90).alias("cutoff")
    )


@query("fn_month_label")
def _(s):
    return s.stg_orders.groupBy(dates.month_label("purchased_at").alias("month")).agg(
        F.count("*").alias("n"))


@query("fn_now")
def _(s):
    aged = s.stg_orders.select(F.col("purchased_at") < F.current_timestamp())
    return aged.toDF("in_past").groupBy("in_past").agg(F.count("*").alias("n"))


@query("fn_round")
def _(s):
    return s.src["order_payments"].groupBy("payment_type").agg(
        rounded(exact_mean("payment_value"), 2).alias("mean_value"),
        rounded(exact_mean("payment_value"), 0).alias("whole_value"),
    )


@query("fn_nullif")
def _(s):
    return s.src["products"].select(
        "product_id", F.nullif("product_photos_qty", F.lit(0)).alias("photos"))


@query("fn_coalesce")
def _(s):
    return s.src["products"].select(
        "product_id", F.coalesce("product_category_name", F.lit("unknown")).alias("category"))


@query("fn_scale")
def _(s):
    return s.kpi_monthly.select(
        "order_month", percent("csat_rate", 2).alias("csat_pct"),
        rounded(F.col("total_gmv_brl") / 1e6, 3).alias("gmv_m_brl"),
    )


@query("fn_priority_score")
def _(s):
    return showcase.retention_priority(
        churn.tiered(s.src["churn_predictions"]), s.dim_customers, TODAY, limit=None
    ).select("customer_unique_id", "churn_prob", "total_spend_brl", "priority_score")


@query("fn_upper")
def _(s):
    return s.stg_customers.select(F.upper("city").alias("city"), "state").distinct()


@query("fn_md5_key")
def _(s):
    return s.stg_order_items.select("order_id", "order_item_id", "order_item_sk")


@query("fn_string_agg")
def _(s):
    kinds = s.src["order_payments"].select("payment_installments", "payment_type").distinct()
    return tables.describe_columns(kinds.select(
        F.col("payment_installments").cast("string").alias("table_name"),
        F.ascii("payment_type").alias("position"),
        F.col("payment_type").alias("column_name"),
    ))


@query("fn_preview")
def _(s):
    return s.src["audit_calls"].select("timestamp", text.preview("sql", 20).alias("preview"))


@query("fn_json_fields")
def _(s):
    parsed = F.from_json(F.to_json("params"), "k string, email string")
    return s.src["audit_calls"].select(
        "timestamp", parsed.getField("k").try_cast("int").alias("k"),
        parsed.getField("email").alias("email"),
    )


@query("fn_redact_map")
def _(s):
    params = text.redacted("params")
    return s.src["audit_calls"].select(
        "timestamp", F.element_at(params, "k").alias("k"),
        F.element_at(params, "email").alias("email"),
        F.element_at(params, "filter").alias("filter"),
    )


@query("mask_customer_id")
def _(s):
    return s.src["contacts"].select(
        "customer_unique_id",
        masking.mask_customer_id("customer_unique_id", DEMO_SECRET).alias("masked"),
        masking.mask_customer_id("name", DEMO_SECRET, 12).alias("masked_name"),
    )


@query("mask_email")
def _(s):
    return s.src["contacts"].select(
        "customer_unique_id", masking.mask_email("email").alias("masked"))


@query("mask_phone")
def _(s):
    return s.src["contacts"].select(
        "customer_unique_id", masking.mask_phone("phone").alias("masked"))


@query("mask_name")
def _(s):
    return s.src["contacts"].select(
        "customer_unique_id", masking.mask_name("name").alias("masked"))


@query("mask_columns")
def _(s):
    return masking.mask_columns(
        s.src["contacts"].select("customer_unique_id", "email", "city"),
        {**MASKS, "email": masking.mask_email},
    )


# ---- streaming ----------------------------------------------------------------------------


def _followed(s: Shop) -> str:
    """The log in two deliveries, followed to the end; then late news of its first day."""
    spark = _spark(s)
    log, table = fresh_path(spark, "audit-log"), fresh_path(spark, "audit-live")
    state = fresh_path(spark, "audit-state")
    early = F.col("timestamp") < "2024-01-15"
    first_day = F.substring("timestamp", 1, 10) == s.audit_log.agg(
        F.substring(F.min("timestamp"), 1, 10)).scalar()
    for rows in (s.audit_log.where(early), s.audit_log.where(~early), s.audit_log.where(first_day)):
        files.append_audit(rows, log)
        stream = audit_live.read_log_stream(spark, log)
        audit_live.follow(stream, table, state).awaitTermination()
    return table


@query("audit_live")
def _(s):
    """Equals the batch rollup of the log: what came too late has changed nothing."""
    rolled = audit_live.current(_spark(s), _followed(s))
    return rolled.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("audit_live_late")
def _(s):
    """How many events came, and how many of them too late."""
    report = audit_live.lateness_report(_spark(s), _followed(s))
    return report.withColumn("seen", F.col("seen").cast("timestamp_ntz"))


@query("kpi_monthly_live")
def _(s):
    """The orders in three deliveries, whose statuses change; equals the batch indicators.

    First every third order is still on its way. Then those arrive, and every fifth is called
    off. Then every fifth is delivered after all, and old news of every seventh comes once more.
    """
    spark = _spark(s)
    key, status = F.col("order_id"), F.col("order_status")
    final = handed_over(kpi_live.order_events(s.dated_orders, F.lit(9)), "final")
    as_status = lambda rows, other, version: rows.withColumns({
        "order_status": F.when(status == kpis.DELIVERED, F.lit(other)).otherwise(status),
        "version": F.lit(version).cast("long"),
    })
    third, fifth = key % 3 == 0, key % 5 == 0
    deliveries = (
        as_status(final.where(third), "shipped", 1).unionByName(final.where(~third & ~fifth))
        .unionByName(final.where(~third & fifth).withColumn("version", F.lit(1).cast("long"))),
        final.where(third & ~fifth).unionByName(as_status(final.where(fifth), "canceled", 2)),
        final.where(fifth).unionByName(as_status(final.where(key % 7 == 0), "unavailable", 0)),
    )
    arrived, out = fresh_path(spark, "order-events"), fresh_path(spark, "kpi-live")
    state = fresh_path(spark, "kpi-state")
    for rows in deliveries:
        rows.write.mode("append").parquet(arrived)
        changes = kpi_live.changes(spark.readStream.schema(final.schema).parquet(arrived))
        kpi_live.follow(changes, out, state).awaitTermination()
    return kpis.monthly_from_sums(kpi_live.current(spark, out))


@query("audit_rollup")
def _(s):
    rolled = audit_live.rollup(s.audit_log)
    return rolled.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ---- models and statistics ----------------------------------------------------------------


@query("impute_median")
def _(s):
    return ml.impute(_features(s)).select(
        "customer_unique_id", *churn.NUMERIC_FEATURES, *churn.CATEGORICAL_FEATURES
    )


@query("column_medians")
def _(s):
    table = ranking.medians(s.churn_features, churn.NUMERIC_FEATURES)
    return table.withColumn("median", rounded("median", 6))


def _split(s: Shop) -> DataFrame:
    """Who trains; keys and labels alone, stored because thresholds and rows read them."""
    return ml.with_split(handed_over(s.churn_labels, "labels"))


@query("stratified_split")
def _(s):
    return _split(s).groupBy("is_train", "is_churned").agg(F.count("*").alias("n"))


@query("stratified_split_members")
def _(s):
    return _split(s)


@query("class_weights")
def _(s):
    return ml.class_weights(s.churn_labels)


def _features(s: Shop) -> DataFrame:
    """Model input read several times by fitting, so kept in reliable storage."""
    return handed_over(s.churn_features)


def _prepared(s: Shop) -> tuple[DataFrame, list[str]]:
    """All rows with their feature vector, and the names of its slots."""
    rows = ml.impute(_features(s))
    prepared = ml.feature_pipeline(rows).fit(rows)
    vector = ml.vector_to_array(ml.FEATURES).alias("v")
    return prepared.transform(rows).select("customer_unique_id", vector), ml.feature_names(prepared)


@query("standard_scale")
def _(s):
    rows, _ = _prepared(s)
    return rows.select("customer_unique_id", *[
        rounded(F.col("v")[i], 4).alias(c) for i, c in enumerate(churn.NUMERIC_FEATURES)
    ])


@query("one_hot")
def _(s):
    """One row per person and slot of a category; no number is read for them."""
    categories = s.churn_features.select("customer_unique_id", *churn.CATEGORICAL_FEATURES)
    rows = ml.impute(handed_over(categories, "categories"), ())
    prepared = ml.feature_pipeline(rows, ()).fit(rows)
    slots = F.arrays_zip(
        F.array(*map(F.lit, ml.feature_names(prepared, ()))).alias("feature"),
        ml.vector_to_array(ml.FEATURES).alias("value"),
    )
    return prepared.transform(rows).select("customer_unique_id", F.inline(slots))


def _fit(s: Shop, model: str) -> ml.Fit:
    return ml.fitted_once(_features(s), model)


def _fits(s: Shop, models: Sequence[str] = ml.MODELS) -> dict[str, ml.Fit]:
    """Models over one stored feature table, prepared once and fitted side by side.

    A boosted model waits for the driver between its many short jobs; other fits use that time.
    """
    features = _features(s)
    ml.prepare(features)
    return dict(zip(models, build.side_by_side(
        [partial(ml.fitted_once, features, m) for m in models])))


def _comparison(fits: dict[str, ml.Fit]) -> DataFrame:
    return ml.comparison({m: f.scored.where("NOT is_train") for m, f in fits.items()})


def _chosen(fits: dict[str, ml.Fit]) -> ml.Fit:
    """The model of the best ROC-AUC on the held-out side."""
    return fits[_comparison(fits).first().model]


@query("logreg_scores")
def _(s):
    return _fit(s, ml.LOGISTIC).scored


@query("forest_scores")
def _(s):
    return _fit(s, ml.FOREST).scored


@query("gbt_scores")
def _(s):
    return _fit(s, ml.BOOSTED).scored


@query("fit_logreg")
def _(s):
    """Slope of the loss at the fitted coefficients: 0 in every direction at the optimum."""
    return ml.optimality(_fit(s, ml.LOGISTIC)).select(
        "feature", rounded("gradient", 4).alias("gradient"))


@query("fit_forest")
def _(s):
    """Everyone's score of the forest against the walk through its node table."""
    return ml.agreement(_fit(s, ml.FOREST))


@query("fit_gbt")
def _(s):
    """Everyone's score of the boosted trees against the walk through their node table."""
    return ml.agreement(_fit(s, ml.BOOSTED))


@query("model_nodes")
def _(s):
    """Faults of both node tables; sizes are parameters of the models."""
    parts = []
    for model, found in _fits(s, (ml.FOREST, ml.BOOSTED)).items():
        nodes = handed_over(ml.trees.node_table(_spark(s), found.path, model == ml.BOOSTED), "nodes")
        sizes = nodes.agg(F.count_distinct("tree").alias("trees")).scalar()
        parts.append(ml.trees.malformed(nodes).withColumns(
            {"model": F.lit(model), "trees": sizes}))
    return parts[0].unionByName(parts[1])


@query("model_comparison")
def _(s):
    return _comparison(_fits(s))


@query("importance_values")
def _(s):
    """All inputs in all three models."""
    tables = [ml.importance(f.fitted, f.names).withColumn("model", F.lit(m))
              for m, f in _fits(s).items()]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("feature_importance")
def _(s):
    """All inputs in all three models: the model's importance against that of its nodes."""
    tables = [ml.importance_agreement(f).withColumn("model", F.lit(m))
              for m, f in _fits(s).items()]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("top_features")
def _(s):
    chosen = _chosen(_fits(s))
    return ml.top_features(ml.importance(chosen.fitted, chosen.names))


def _exported(chosen: ml.Fit) -> DataFrame:
    threshold = ml.best_threshold(chosen.scored.where("NOT is_train"))
    return ml.predictions(chosen.scored, threshold, chosen.model)


@query("customer_scores")
def _(s):
    return _exported(_chosen(_fits(s)))


@query("score_customers")
def _(s):
    """The exported score file against recomputed scores and the threshold's definition."""
    chosen = _chosen(_fits(s))
    again = handed_over(ml.recomputed(chosen).withColumnRenamed("score", "_again"), "again")
    held_out = chosen.scored.where("NOT is_train")
    bound = ml.best_threshold(held_out).select("threshold").scalar()
    probability, called = F.col("churn_probability"), F.col("predicted_label") == 1
    near = F.abs(F.col("_again") - F.col("_bound")) < 1e-9
    return _exported(chosen).join(again, "customer_unique_id", "left").withColumn(
        "_bound", bound
    ).select(
        "customer_unique_id",
        (F.abs(probability - F.col("_again")) <= 5.1e-7).alias("probability_agrees"),
        (near | (called == (F.col("_again") >= F.col("_bound")))).alias("label_agrees"),
        F.col("model_name").isin(*ml.MODELS).alias("known_model"),
        F.col("prediction_generated_at").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
        .alias("timed"),
    )


def _given_scores(s: Shop) -> DataFrame:
    """Fixed scores against the real labels, so that metrics can be checked exactly."""
    return s.churn_labels.select("customer_unique_id", F.col("is_churned").alias("label")).join(
        s.src["churn_predictions"].select(
            "customer_unique_id", F.col("churn_probability").alias("score")),
        "customer_unique_id",
    )


@query("best_threshold")
def _(s):
    return ml.best_threshold(_given_scores(s)).select(
        "threshold", rounded("best_f1", 6).alias("best_f1"))


@query("eval_metrics")
def _(s):
    return ml.evaluation(_given_scores(s))


@query("roc_points")
def _(s):
    return ml.roc_points(_given_scores(s))


@query("retention_priority")
def _(s):
    return showcase.retention_priority(
        churn.tiered(s.src["churn_predictions"]), s.dim_customers, TODAY
    )


def _rated(s: Shop) -> DataFrame:
    return stats.rated_deliveries(s.int_orders)


@query("ab_groups")
def _(s):
    return stats.rounded_result(stats.group_moments(_rated(s)))


@query("ab_welch")
def _(s):
    tested = stats.with_welch(stats.group_moments(_rated(s)))
    return stats.rounded_result(tested.select("t_statistic", "degrees_of_freedom"), 4)


@query("ab_p_value")
def _(s):
    tested = stats.with_p_value(stats.with_welch(stats.group_moments(_rated(s))))
    return tested.select(
        rounded("t_statistic", 4).alias("t_statistic"),
        rounded("degrees_of_freedom", 4).alias("degrees_of_freedom"),
        rounded("p_value", 6).alias("p_value"),
    )


@query("ab_cohens_d")
def _(s):
    return stats.rounded_result(
        stats.with_effect(stats.group_moments(_rated(s))).select("cohens_d", "effect"), 5)


@query("ab_conclusion")
def _(s):
    return stats.rounded_result(stats.conclusion(_rated(s)).select(
        "fast_n", "slow_n", "difference", "cohens_d", "effect", "significant",
        "worth_investing",
    ), 4)


# ---- data quality and access log ----------------------------------------------------------


@query("dq_not_null")
def _(s):
    return s.int_orders.agg(*[
        quality.nulls(c).alias(c) for c in
        ("order_id", "customer_delivered_at", "total_payment_value", "review_score")
    ])


@query("dq_unique")
def _(s):
    return quality.duplicated_keys(s.src["order_payments"], "order_id")


@query("dq_composite_key")
def _(s):
    return quality.duplicated_keys(
        s.src["order_payments"], "order_id", "payment_sequential"
    )


@query("dq_accepted_values")
def _(s):
    return s.stg_orders.agg(
        quality.outside("order_status", segments.ORDER_STATUSES).alias("unknown_status"),
        quality.outside("order_status", ("delivered", "canceled")).alias("still_open"),
    )


@query("dq_report")
def _(s):
    """All 57 checks. Models used by several others are stored once before they are read."""
    stored = Shop(s.src)
    for model in ("int_orders", "int_customer_orders", "dim_customers", "fct_orders"):
        setattr(stored, model, handed_over(getattr(stored, model)))
    return quality.report(stored.all_tables())


@query("audit_event")
def _(s):
    return s.audit_log.select(
        "timestamp", "level", "function", "row_count", "duration_ms", "sql_preview", "status",
        "error", "warning", F.element_at("params", "email").alias("email"),
    )


REGISTRY["audit_summary"] = lambda s: audit.summary(s.audit_log)
REGISTRY["audit_summary_info"] = lambda s: audit.summary(audit.only_level(s.audit_log, "INFO"))
REGISTRY["audit_calls_per_tool"] = lambda s: audit.calls_per_function(s.audit_log)
REGISTRY["audit_avg_duration"] = lambda s: audit.mean_duration(s.audit_log)
REGISTRY["audit_rows_per_function"] = lambda s: audit.rows_per_function(s.audit_log)


@query("audit_history")
def _(s):
    return audit.history(s.audit_log)


def _log_columns(df: DataFrame) -> DataFrame:
    return df.select("timestamp", "level", "session", "function", "row_count", "status")


@query("audit_window")
def _(s):
    return _log_columns(audit.between(
        s.audit_log, "2024-01-10T00:00:00", "2024-01-12T23:59:59"))


@query("audit_bulk")
def _(s):
    return _log_columns(audit.bulk_reads(s.audit_log))


@query("audit_session")
def _(s):
    return _log_columns(audit.of_session(s.audit_log, "s7"))


@query("audit_errors")
def _(s):
    return _log_columns(audit.failures(s.audit_log))


@query("audit_suspicious")
def _(s):
    return _log_columns(audit.suspicious(s.audit_log))


@query("audit_timeline")
def _(s):
    return audit.timeline(s.audit_log, "2024-01-05")
