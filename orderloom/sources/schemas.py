"""Declared layout of every source; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the nine source files and of the two side inputs.
ORDERS = """
    order_id string, customer_id string, order_status string,
    order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
    order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
    order_estimated_delivery_date timestamp_ntz
"""
CUSTOMERS = """
    customer_id string, customer_unique_id string, customer_zip_code_prefix int,
    customer_city string, customer_state string
"""
ORDER_ITEMS = """
    order_id string, order_item_id int, product_id string, seller_id string,
    shipping_limit_date timestamp_ntz, price double, freight_value double
"""
ORDER_PAYMENTS = """
    order_id string, payment_sequential int, payment_type string,
    payment_installments int, payment_value double
"""
ORDER_REVIEWS = """
    review_id string, order_id string, review_score int, review_comment_title string,
    review_comment_message string, review_creation_date timestamp_ntz,
    review_answer_timestamp timestamp_ntz
"""
PRODUCTS = """
    product_id string, product_category_name string, product_name_lenght int,
    product_description_lenght int, product_photos_qty int, product_weight_g double,
    product_length_cm double, product_height_cm double, product_width_cm double
"""
SELLERS = """
    seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string
"""
GEOLOCATION = """
    geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double,
    geolocation_city string, geolocation_state string
"""
CATEGORY_TRANSLATION = "product_category_name string, product_category_name_english string"
CHURN_PREDICTIONS = """
    customer_unique_id string, churn_probability double, predicted_label int,
    model_name string, prediction_generated_at string
"""
AUDIT_LOG = """
    timestamp string, level string, session string, logger string, event string,
    function string, params map<string,string>, row_count bigint, duration_ms double,
    sql_preview string, status string, error string, warning string
"""

SOURCES = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "category_translation": CATEGORY_TRANSLATION,
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def as_text(ddl: str) -> T.StructType:
    """Same columns, all as text: what a CSV scan delivers before casting."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in struct(ddl)])
