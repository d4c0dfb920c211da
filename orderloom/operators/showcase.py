"""Trend, cohort, ranking and targeting queries over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import date_of, month_start
from ..functions.numeric import as_column, exact, percent, ratio, rounded
from ..functions.segments import (
    RETAINED_STATUSES, loyalty_weight, recommended_action, retention_label, seller_flag,
    spend_tier,
)
from ..session import handed_over
from .kpis import DELIVERED, at_least, with_status


# Month-grain windows run in one task on purpose: their input is one row per month.


def month_over_month(kpi: DataFrame) -> DataFrame:
    """Change against the previous row of the monthly table."""
    in_time = Window.orderBy("month")

    def change(name: str) -> Column:
        return F.col(name) - F.lag(name).over(in_time)

    months = kpi.select(
        date_of("order_month").alias("month"),
        "total_orders",
        percent("csat_rate").alias("csat_pct"),
        percent("on_time_rate").alias("on_time_pct"),
        rounded(F.col("total_gmv_brl") / 1000.0, 1).alias("gmv_k_brl"),
    )
    growth = ratio(change("gmv_k_brl"), F.lag("gmv_k_brl").over(in_time))
    return months.select(
        "month", "total_orders",
        "csat_pct", rounded(change("csat_pct"), 1).alias("csat_delta_pp"),
        "on_time_pct", rounded(change("on_time_pct"), 1).alias("on_time_delta_pp"),
        "gmv_k_brl", percent(growth).alias("gmv_growth_pct"),
    ).orderBy("month")


def running(kpi: DataFrame) -> DataFrame:
    """Cumulative orders and revenue, and the order-weighted score so far."""
    so_far = Window.orderBy("order_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def upto(c: Column | str) -> Column:
        return F.sum(as_column(c)).over(so_far)

    orders = upto("total_orders")
    weighted = upto(exact("avg_review_score") * F.col("total_orders")).cast("double")
    return kpi.select(
        date_of("order_month").alias("month"),
        "total_orders",
        rounded(F.col("total_gmv_brl") / 1000.0, 1).alias("gmv_k_brl"),
        orders.alias("cumulative_orders"),
        rounded(upto(exact("total_gmv_brl")).cast("double") / 1000.0, 1)
        .alias("cumulative_gmv_k_brl"),
        rounded(ratio(weighted, orders), 3).alias("running_avg_review"),
    ).orderBy("month")


def top_decile_spenders(people: DataFrame, limit: int = 100) -> DataFrame:
    """The highest spenders of the top tenth, with percentile and rank in their state.

    No global sort is needed. The tenth tile holds the last ``rows div 10`` people, so it is
    a prefix of the top list; everyone who outspends a listed person is on the list too, so
    both ranks follow from the list plus one count of ties at its lower end.
    """
    spenders = people.where(F.col("total_spend_brl") > 0).select(
        "customer_unique_id", "state", "total_orders", "total_spend_brl", "avg_review_score",
        "order_frequency_segment", "satisfaction_segment",
    )
    total = spenders.agg(F.count("*")).scalar()
    downwards = [F.desc("total_spend_brl"), F.desc("customer_unique_id")]
    # a report of at most `limit` rows: its windows may run in one task
    top = (
        spenders.orderBy(*downwards).limit(limit)
        .withColumn("_place", F.row_number().over(Window.orderBy(*downwards)))
        .withColumn("rank_in_state", F.rank().over(
            Window.partitionBy("state").orderBy(F.desc("total_spend_brl"))).cast("bigint"))
    )
    spend = F.col("total_spend_brl")
    lowest = top.agg(F.min("total_spend_brl")).scalar()
    at_or_above = (
        spenders.where(spend >= lowest)
        .groupBy("total_spend_brl").agg(F.count("*").alias("_n"))
        .withColumn("_reaching", F.sum("_n").over(
            Window.orderBy(F.desc("total_spend_brl"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    below = F.col("_total") - F.col("_reaching")
    percentile = F.coalesce(ratio(below, F.col("_total") - 1), F.lit(0.0))
    return (
        top.join(at_or_above, "total_spend_brl")
        .withColumn("_total", total)
        .where(F.col("_place") <= F.floor(F.col("_total") / 10))
        .withColumn("spend_decile", F.lit(10).cast("bigint"))
        .select(
            "customer_unique_id", "state", "total_orders",
            rounded(spend, 2).alias("total_spend_brl"),
            "avg_review_score", "order_frequency_segment", "satisfaction_segment",
            "spend_decile",
            rounded(percentile, 4).alias("spend_percentile"),
            "rank_in_state",
            spend_tier("spend_decile").alias("spend_tier"),
        )
        .orderBy(*downwards)
    )


def cohort_retention(fact: DataFrame, min_size: int = 50) -> DataFrame:
    """People by month of first order, and how many of them ordered again.

    First month and number of orders come from one aggregate per person, so the orders are
    neither numbered nor joined to themselves.
    """
    person = F.col("customer_unique_id")
    people = with_status(fact, *RETAINED_STATUSES).groupBy(person).agg(
        F.min("purchased_at").alias("first_at"), F.count("*").alias("n")
    )
    again = person.isNotNull() & (F.col("n") >= 2)
    sized = people.groupBy(date_of(month_start("first_at")).alias("cohort_month")).agg(
        F.count("*").alias("cohort_size"), F.count_if(again).alias("returned_customers")
    )
    return (
        at_least(sized, "cohort_size", min_size)
        .withColumn("retention_pct", percent(ratio("returned_customers", "cohort_size"), 2))
        .withColumn("retention_label", retention_label("retention_pct"))
        .orderBy("cohort_month")
    )


def retention_priority(
    scores: DataFrame, people: DataFrame, today: str = "2018-10-17", min_spend: float = 100,
    limit: int | None = 50,
) -> DataFrame:
    """Whom to contact first: churn risk, spend relative to the best customer, loyalty.

    ``limit`` None lists everybody.
    """
    risk = scores.select(
        "customer_unique_id",
        rounded("churn_probability", 3).alias("churn_prob"),
        "churn_risk_tier",
    )
    spend = F.col("total_spend_brl")
    context = people.where(spend >= min_spend).select(
        "customer_unique_id", "state", "total_orders", "total_spend_brl", "avg_review_score",
        "order_frequency_segment", "satisfaction_segment", "last_order_at",
    )
    listed = risk.join(context, "customer_unique_id")
    highest = listed.agg(F.max(spend)).scalar()
    priority = rounded(
        F.col("churn_prob") * 0.5
        + ratio(spend, "_highest") * 0.35
        + loyalty_weight("order_frequency_segment"),
        4,
    )
    ranked = (
        listed.withColumn("_highest", highest)
        .withColumn("_priority", priority)
        .orderBy(F.desc_nulls_last("_priority"), "customer_unique_id")
    )
    return (
        (ranked if limit is None else ranked.limit(limit))
        .select(
            "customer_unique_id", "churn_prob", "churn_risk_tier", "state", "total_orders",
            rounded(spend, 2).alias("total_spend_brl"),
            rounded("avg_review_score", 2).alias("avg_review_score"),
            "order_frequency_segment", "satisfaction_segment",
            date_of("last_order_at").alias("last_order_date"),
            F.datediff(F.lit(today).cast("date"), F.col("last_order_at")).cast("bigint")
            .alias("days_inactive"),
            rounded("_priority", 3).alias("priority_score"),
            recommended_action("churn_risk_tier", "satisfaction_segment")
            .alias("recommended_action"),
        )
    )


def seller_category_performance(
    fact: DataFrame, items: DataFrame, products: DataFrame, min_orders: int = 20
) -> DataFrame:
    """Delivery performance per seller and category; every delivered item row counts.

    Items are counted per order, seller and category before they meet the orders, and the
    means are weighted by those counts. An order with very many lines is spread over its
    sellers and categories by then, and orders need no distinct count any more (``fact`` has
    one row per order).
    """
    category = F.coalesce("category_name_en", F.lit("unknown")).alias("category_en")
    lines = (
        items.select("order_id", "product_id", "seller_id")
        .join(products.select("product_id", category), "product_id")
        .groupBy("order_id", "seller_id", "category_en").agg(F.count("*").alias("n"))
    )
    delivered = with_status(fact, DELIVERED).where(F.col("days_to_deliver").isNotNull()).select(
        "order_id", "days_to_deliver", "review_score", "delivered_on_time"
    )
    n = F.col("n")

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * n), F.sum(F.when(F.col(c).isNotNull(), n)))

    on_time = F.coalesce(F.sum(F.when(F.col("delivered_on_time"), n)), F.lit(0))
    return at_least(
        lines.join(delivered, "order_id").groupBy("seller_id", "category_en").agg(
            F.count("*").alias("orders"),
            rounded(weighted("days_to_deliver"), 1).alias("avg_delivery_days"),
            rounded(weighted("review_score"), 2).alias("avg_review"),
            percent(ratio(on_time, F.sum(n))).alias("on_time_pct"),
        ),
        "orders", min_orders,
    )


def category_places(performance: DataFrame) -> DataFrame:
    """Rank, distance to the median and size for every mean delivery time of a category.

    Means are kept to a tenth of a day, so a category has at most some thousand different
    values however many sellers it has; all three figures follow from counts per value.
    """
    counts = performance.groupBy("category_en", "avg_delivery_days").agg(
        F.count("*").alias("_n")
    )
    category = Window.partitionBy("category_en")
    slower = category.orderBy(F.desc("avg_delivery_days")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    median = F.percentile("avg_delivery_days", 0.5, F.col("_n")).over(category)
    return counts.select(
        "category_en", "avg_delivery_days",
        (F.coalesce(F.sum("_n").over(slower), F.lit(0)) + 1).alias("delivery_rank_in_category"),
        rounded(F.col("avg_delivery_days") - median, 1).alias("days_above_category_median"),
        F.sum("_n").over(category).alias("sellers_in_category"),
    )


def seller_ranking(performance: DataFrame, worst: int | None = 5) -> DataFrame:
    """Slowest sellers of each category, ties included; all sellers if ``worst`` is None."""
    performance = handed_over(performance)  # read for the places and for the rows
    places = category_places(performance)
    if worst is not None:
        places = places.where(F.col("delivery_rank_in_category") <= worst)
    return (
        performance.join(places, ["category_en", "avg_delivery_days"])
        .select(
            "seller_id", "category_en", "orders", "avg_delivery_days", "on_time_pct",
            "avg_review", "delivery_rank_in_category", "days_above_category_median",
            "sellers_in_category",
            seller_flag("delivery_rank_in_category", "days_above_category_median")
            .alias("performance_flag"),
        )
        .orderBy("category_en", "delivery_rank_in_category", "seller_id")
    )
