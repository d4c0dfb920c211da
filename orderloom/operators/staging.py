"""Typed, renamed views of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import any_true, surrogate_key
from ..functions.numeric import money_sum, rounded


def _time(name: str):
    return F.col(name).try_cast("timestamp_ntz")


def orders(source: DataFrame) -> DataFrame:
    return source.select(
        "order_id", "customer_id", "order_status",
        _time("order_purchase_timestamp").alias("purchased_at"),
        _time("order_approved_at").alias("approved_at"),
        _time("order_delivered_carrier_date").alias("carrier_delivered_at"),
        _time("order_delivered_customer_date").alias("customer_delivered_at"),
        _time("order_estimated_delivery_date").alias("estimated_delivery_at"),
    )


def customers(source: DataFrame) -> DataFrame:
    return source.select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def order_items(source: DataFrame) -> DataFrame:
    return source.select(
        surrogate_key("order_id", "order_item_id").alias("order_item_sk"),
        "order_id", "order_item_id", "product_id", "seller_id",
        _time("shipping_limit_date").alias("shipping_limit_at"),
        "price", "freight_value",
    )


def order_payments(source: DataFrame) -> DataFrame:
    """One row per order. ``payment_installments_total`` counts payment rows."""
    kind = F.col("payment_type")
    # the type decides ties last, so the largest row names it and is all that moves
    largest = F.max(F.when(
        F.col("payment_value").isNotNull(), F.struct("payment_value", "payment_sequential", "payment_type")
    ))
    return source.groupBy("order_id").agg(
        F.count("*").alias("payment_installments_total"),
        rounded(money_sum("payment_value"), 2).alias("total_payment_value"),
        largest["payment_type"].alias("primary_payment_type"),
        *[
            any_true(kind == name).alias(f"used_{name}")
            for name in ("voucher", "boleto", "credit_card", "debit_card")
        ],
    )


def order_reviews(source: DataFrame) -> DataFrame:
    return source.select(
        "review_id", "order_id",
        F.col("review_score").try_cast("int").alias("review_score"),
        F.col("review_comment_title").alias("comment_title"),
        F.col("review_comment_message").alias("comment_message"),
        _time("review_creation_date").alias("review_created_at"),
        _time("review_answer_timestamp").alias("review_answered_at"),
    )


def products(source: DataFrame, translation: DataFrame) -> DataFrame:
    """Translated category where there is one, otherwise the original name.

    Whether the translation is broadcast is left to Spark's size check.
    """
    name = "product_category_name"
    return source.join(translation, name, "left").select(
        "product_id",
        F.coalesce("product_category_name_english", name).alias("category_name_en"),
        F.col(name).alias("category_name_pt"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        F.col("product_photos_qty").alias("photos_qty"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )


def sellers(source: DataFrame) -> DataFrame:
    return source.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )
