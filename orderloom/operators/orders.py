"""Order grain: enrichment and the order fact.

All joins on ``order_id`` come first, so the orders are shuffled on that key once and the
rolled-up payments, reviews and items meet them there. Every right-hand side is aggregated
to its key before the join: an order with very many lines collapses on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import days_between, hours_between, month_start, week_start, weekday
from ..functions.keys import any_true, surrogate_key, value_at_min
from ..functions.numeric import money_part, money_sum, money_total, money_whole, rounded
from ..functions.text import has_text

REVIEW_COLUMNS = (
    "review_score", "comment_title", "comment_message",
    "review_created_at", "review_answered_at",
)


def latest_review(reviews: DataFrame, columns: tuple[str, ...] = REVIEW_COLUMNS) -> DataFrame:
    """Newest review of each order; equal times are decided by the review id.

    An aggregate rather than a numbered window: it combines before the shuffle, and the
    optimizer knows the result is unique per order, so unused joins to it disappear.
    """
    newest = F.max_by(F.struct(*columns), F.struct("review_created_at", "review_id"))
    return reviews.groupBy("order_id").agg(newest.alias("r")).select("order_id", "r.*")


def _with_commented(reviews: DataFrame) -> DataFrame:
    """Review verdicts without the texts, which need not travel through the shuffle."""
    return latest_review(
        reviews.withColumn("has_review_comment", has_text("comment_message")),
        ("review_score", "has_review_comment", "review_created_at"),
    )


def delivered_on_time(delivered: str, estimated: str) -> Column:
    """NULL while undelivered."""
    return F.col(delivered) <= F.col(estimated)


def enriched(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with delivery speed, payment and latest review."""
    return (
        orders.join(payments, "order_id", "left")
        .join(_with_commented(reviews), "order_id", "left")
        .select(
            "order_id", "customer_id", "order_status", "purchased_at", "approved_at",
            "carrier_delivered_at", "customer_delivered_at", "estimated_delivery_at",
            days_between("purchased_at", "customer_delivered_at").alias("days_to_deliver"),
            days_between("estimated_delivery_at", "customer_delivered_at")
            .alias("delivery_delta_days"),
            delivered_on_time("customer_delivered_at", "estimated_delivery_at")
            .alias("delivered_on_time"),
            hours_between("purchased_at", "approved_at").alias("hours_to_approve"),
            "total_payment_value", "primary_payment_type", "used_voucher", "used_credit_card",
            "review_score",
            F.coalesce("has_review_comment", F.lit(False)).alias("has_review_comment"),
            "review_created_at",
        )
    )


def item_rollup(items: DataFrame) -> DataFrame:
    """Basket of each order.

    Two rollups that end on the same key, each combining on the map side: counting products and
    sellers together on the lines would triple every line before it is aggregated, and a set of
    products would hold a very large order in one row. Amounts stay two integers until both are done,
    as decimals would leave the fast path of the aggregate.
    """
    by_product = items.groupBy("order_id", "product_id").agg(
        F.count("*").alias("_lines"),
        *[F.sum(part(c)).alias(f"_{name}_{c}") for c in ("price", "freight_value")
          for name, part in (("whole", money_whole), ("part", money_part))],
    )
    by_seller = items.groupBy("order_id", "seller_id").agg(F.lit(1).alias("_one"))
    baskets = by_product.groupBy("order_id").agg(
        F.sum("_lines").alias("item_count"),
        F.count("product_id").alias("distinct_products"),
        *[money_total(F.sum(f"_whole_{c}"), F.sum(f"_part_{c}")).cast("double").alias(total)
          for c, total in (("price", "items_subtotal_brl"), ("freight_value", "freight_total_brl"))],
    )
    sellers = by_seller.groupBy("order_id").agg(F.count("seller_id").alias("distinct_sellers"))
    return baskets.join(sellers, "order_id").select(
        "order_id", "item_count", "distinct_products", "distinct_sellers", "items_subtotal_brl",
        "freight_total_brl",
    )


def with_date_parts(orders: DataFrame, bought: str = "purchased_at") -> DataFrame:
    return orders.withColumns({
        "order_month": month_start(bought),
        "order_week": week_start(bought),
        "order_day_of_week": weekday(bought),
    })


FACT_COLUMNS = (
    "order_id", "customer_unique_id", "customer_sk", "order_status", "purchased_at",
    "approved_at", "customer_delivered_at", "estimated_delivery_at", "item_count",
    "distinct_products", "distinct_sellers", "items_subtotal_brl", "freight_total_brl",
    "total_payment_value", "primary_payment_type", "used_voucher", "used_credit_card",
    "days_to_deliver", "delivery_delta_days", "delivered_on_time", "hours_to_approve",
    "review_score", "has_review_comment", "review_created_at", "order_month", "order_week",
    "order_day_of_week",
)


def fact(
    orders: DataFrame, customers: DataFrame, items: DataFrame, dimension: DataFrame | None = None
) -> DataFrame:
    """Order fact: enriched orders, basket, person keys and date parts.

    The surrogate key is a function of the person key, and the customer dimension holds
    every person of ``customers``; so the key is computed and the fact does not wait for the
    dimension. Pass ``dimension`` to look the key up instead, e.g. in a partial dimension.
    """
    joined = (
        orders.join(item_rollup(items), "order_id", "left")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id", "left")
    )
    person = F.col("customer_unique_id")
    if dimension is None:
        joined = joined.withColumn(
            "customer_sk", F.when(person.isNotNull(), surrogate_key(person))
        )
    else:
        joined = joined.join(
            dimension.select("customer_unique_id", "customer_sk"), "customer_unique_id", "left"
        )
    return with_date_parts(joined).select(*FACT_COLUMNS)


# ---- the twin built on the bronze tables, which keep the source column names --------------


def payments_first_kind(payments: DataFrame) -> DataFrame:
    """Per order: total, first defined payment type by sequence, two any-flags."""
    kind = F.col("payment_type")
    defined = F.when(kind != "not_defined", F.col("payment_sequential"))
    return payments.groupBy("order_id").agg(
        rounded(money_sum("payment_value"), 2).alias("total_payment_value"),
        value_at_min(kind, defined, "payment_value", kind).alias("primary_payment_type"),
        F.coalesce(any_true(kind == "voucher"), F.lit(False)).alias("used_voucher"),
        F.coalesce(any_true(kind == "credit_card"), F.lit(False)).alias("used_credit_card"),
    )


def silver(orders: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Enriched orders under the source column names, with date parts."""
    bought, delivered = "order_purchase_timestamp", "order_delivered_customer_date"
    due = "order_estimated_delivery_date"
    slim = _with_commented(reviews.withColumnRenamed("review_comment_message", "comment_message"))
    joined = (
        orders.join(payments_first_kind(payments), "order_id", "left")
        .join(slim, "order_id", "left")
        .select(
            "order_id", "customer_id", "order_status", bought, "order_approved_at",
            "order_delivered_carrier_date", delivered, due,
            days_between(bought, delivered).alias("days_to_deliver"),
            days_between(due, delivered).alias("delivery_delta_days"),
            delivered_on_time(delivered, due).alias("delivered_on_time"),
            hours_between(bought, "order_approved_at").alias("hours_to_approve"),
            "total_payment_value", "primary_payment_type", "used_voucher", "used_credit_card",
            "review_score",
            F.coalesce("has_review_comment", F.lit(False)).alias("has_review_comment"),
            "review_created_at",
        )
    )
    return with_date_parts(joined, bought)
