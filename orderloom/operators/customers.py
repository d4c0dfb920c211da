"""Person grain: order history, dimension and address."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import days_between
from ..functions.keys import surrogate_key
from ..functions.numeric import money_part, money_total, money_whole, ratio, rounded
from ..functions.segments import frequency_segment, satisfaction_segment


def _history_by_account(orders: DataFrame, *more: Column) -> DataFrame:
    """Additive order history per account id.

    Runs before the join to accounts: its shuffle is the one the join needs anyway, and an
    account with very many orders is already one row when it gets there.
    """
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("n_orders"),
        F.count_if(F.col("order_status") == "delivered").alias("n_delivered"),
        F.count_if(F.col("order_status") == "canceled").alias("n_canceled"),
        F.min("purchased_at").alias("first_at"),
        F.max("purchased_at").alias("last_at"),
        F.sum(money_whole("total_payment_value")).alias("spend_whole"),
        F.sum(money_part("total_payment_value")).alias("spend_part"),
        F.count("total_payment_value").alias("n_paid"),
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("n_scored"),
        F.sum("days_to_deliver").alias("days"),
        F.count("days_to_deliver").alias("n_days"),
        F.count_if("delivered_on_time").alias("n_on_time"),
        *more,
    )


def _total(name: str):
    return F.coalesce(F.sum(name), F.lit(0))


def _history(
    orders: DataFrame, customers: DataFrame, keep: str,
    more: Mapping[str, tuple[Column, Column]] = {},
) -> DataFrame:
    """``more`` names further columns, each with what an account adds and how that is merged."""
    accounts = customers.select("customer_id", "customer_unique_id", "state", "city")
    added = [account.alias(name) for name, (account, _) in more.items()]
    joined = _history_by_account(orders, *added).join(accounts, "customer_id", keep)
    newest = F.when(F.col("last_at").isNotNull(), F.struct("last_at", "customer_id"))
    rolled = joined.groupBy("customer_unique_id").agg(
        F.max_by(F.struct("state", "city"), newest).alias("address"),
        *[_total(n).alias(n) for n in (
            "n_orders", "n_delivered", "n_canceled", "n_paid", "n_scored", "n_days", "n_on_time"
        )],
        F.min("first_at").alias("first_order_at"),
        F.max("last_at").alias("last_order_at"),
        money_total(F.sum("spend_whole"), F.sum("spend_part")).alias("spend"),
        *[F.sum(n).alias(n) for n in ("score", "days")],
        *[merge.alias(name) for name, (_, merge) in more.items()],
    )
    return rolled.select(
        "customer_unique_id",
        F.col("address.state").alias("state"),
        F.col("address.city").alias("city"),
        F.col("n_orders").alias("total_orders"),
        F.col("n_delivered").alias("delivered_orders"),
        F.col("n_canceled").alias("canceled_orders"),
        "first_order_at", "last_order_at",
        days_between("first_order_at", "last_order_at").alias("customer_lifespan_days"),
        rounded("spend", 2).alias("total_spend_brl"),
        rounded(ratio("spend", "n_paid"), 2).alias("avg_order_value_brl"),
        rounded(ratio("score", "n_scored"), 2).alias("avg_review_score"),
        F.col("n_scored").alias("review_count"),
        rounded(ratio("days", "n_days"), 1).alias("avg_days_to_deliver"),
        F.col("n_on_time").alias("on_time_deliveries"),
        *more,
    )


def order_history(
    customers: DataFrame, orders: DataFrame, more: Mapping[str, tuple[Column, Column]] = {}
) -> DataFrame:
    """Order history of every person, including those who never ordered."""
    return _history(orders, customers, "right", more)


def with_segments(history: DataFrame, zero_order_label: str = "loyal") -> DataFrame:
    return history.withColumns({
        "order_frequency_segment": frequency_segment("total_orders", zero_order_label),
        "satisfaction_segment": satisfaction_segment("avg_review_score"),
    })


def silver(customers: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """Order history of every person who ordered, with segments."""
    orders = silver_orders.withColumnRenamed("order_purchase_timestamp", "purchased_at")
    return with_segments(_history(orders, customers, "left"))


DIMENSION_COLUMNS = (
    "customer_sk", "customer_unique_id", "city", "state", "lat", "lng", "total_orders",
    "delivered_orders", "canceled_orders", "first_order_at", "last_order_at",
    "customer_lifespan_days", "total_spend_brl", "avg_order_value_brl", "avg_review_score",
    "review_count", "avg_days_to_deliver", "on_time_deliveries", "order_frequency_segment",
    "satisfaction_segment",
)


def dimension(
    history: DataFrame, centroids: DataFrame, zero_order_label: str = "loyal"
) -> DataFrame:
    """Customer dimension: history, centroid of the latest city, two segments."""
    return (
        with_segments(history, zero_order_label)
        .join(centroids, ["city", "state"], "left")
        .withColumn("customer_sk", surrogate_key("customer_unique_id"))
        .select(*DIMENSION_COLUMNS)
    )


def gold_segments(silver_customers: DataFrame, centroids: DataFrame) -> DataFrame:
    """Silver customers with the centroid of their city."""
    columns = ["customer_unique_id", "state", "city", "lat", "lng", *DIMENSION_COLUMNS[6:]]
    return silver_customers.join(centroids, ["city", "state"], "left").select(*columns)


def latest_address(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """State and city of each person's newest order."""
    return _history(orders, customers, "left").select("customer_unique_id", "state", "city")
