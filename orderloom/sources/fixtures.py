"""The nine sources derived from the supplied star-schema tables (see FIXTURES.md).

Every mapping is a projection of one table, or of one table joined to its dimension, so it
scales with the tables and adds no shuffle of its own to the fact side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table; its files are asked for their schema once per session, not at every use."""
    path = f"{folder}/{table}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "orders")
        .selectExpr(
            "o_orderkey AS order_id",
            "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400)"
            " AS order_purchase_timestamp",
            """CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 4 <> 0 THEN 'delivered'
               ELSE CASE o_orderkey % 7 WHEN 0 THEN 'canceled' WHEN 1 THEN 'shipped'
                    WHEN 2 THEN 'created' WHEN 3 THEN 'approved' WHEN 4 THEN 'invoiced'
                    WHEN 5 THEN 'processing' ELSE 'unavailable' END
               END AS order_status""",
        )
        .selectExpr(
            "order_id",
            "concat('u', lpad(string(order_id), 10, '0')) AS customer_id",
            "order_status",
            "order_purchase_timestamp",
            """CASE WHEN order_status <> 'created' THEN order_purchase_timestamp
               + make_dt_interval(0, 0, int(order_id * 37 % 2880)) END AS order_approved_at""",
            """CASE WHEN order_status IN ('delivered', 'shipped') THEN order_purchase_timestamp
               + make_dt_interval(0, int(12 + order_id * 13 % 96)) END
               AS order_delivered_carrier_date""",
            """CASE WHEN order_status = 'delivered' AND order_id % 101 <> 0
               THEN order_purchase_timestamp
               + make_dt_interval(0, int(30 + order_id * 7919 % 900)) END
               AS order_delivered_customer_date""",
            """CAST(date(order_purchase_timestamp) AS timestamp_ntz)
               + make_dt_interval(int(10 + order_id * 31 % 25))
               AS order_estimated_delivery_date""",
        )
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    placed = read(spark, folder, "orders").selectExpr("o_orderkey", "o_custkey AS c_custkey")
    homes = read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        placed.join(homes, "c_custkey")
        .selectExpr(
            "o_orderkey", "c_custkey",
            "(c_nationkey + if(o_orderkey % 10 = 0, 1, 0)) % 25 AS n_nationkey",
        )
        .join(nations, "n_nationkey")
        .selectExpr(
            "concat('u', lpad(string(o_orderkey), 10, '0')) AS customer_id",
            "md5(string(c_custkey)) AS customer_unique_id",
            "int(n_nationkey * 100 + o_orderkey % 7) AS customer_zip_code_prefix",
            "concat('city_', n_nationkey, '_', o_orderkey % 3) AS customer_city",
            "n_name AS customer_state",
        )
    )


FREIGHT = "double(floor(l_extendedprice * 5)) / 100D"


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """The item number is a hash of the line: numbering the lines of an order by a window would
    pull a very large order into one task, and 60 bits keep the lines of an order apart."""
    return read(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        """CAST(conv(substring(md5(concat_ws('|', l_partkey, l_suppkey, date_format(l_shipdate,
            'yyyy-MM-dd'), l_linenumber)), 1, 15), 16, 10) AS bigint) AS order_item_id""",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        f"{FREIGHT} AS freight_value",
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        """CASE (l_orderkey + l_linenumber + l_partkey) % 9
           WHEN 0 THEN 'voucher' WHEN 1 THEN 'boleto' WHEN 2 THEN 'boleto'
           WHEN 3 THEN 'debit_card' WHEN 8 THEN 'not_defined'
           ELSE 'credit_card' END AS payment_type""",
        "int(l_orderkey % 12 + 1) AS payment_installments",
        f"l_extendedprice + {FREIGHT} AS payment_value",
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return (
        orders(spark, folder)
        .where("order_delivered_customer_date IS NOT NULL AND order_id % 13 <> 0")
        .selectExpr(
            "order_id", "order_delivered_customer_date AS delivered",
            "explode(if(order_id % 20 = 0, array(0, 1), array(0))) AS j",
        )
        .selectExpr(
            "concat('r', order_id, '_', j) AS review_id",
            "order_id",
            """int(greatest(1, 5 - floor((30 + order_id * 7919 % 900) / 216D)
               - (order_id + j) % 2)) AS review_score""",
            "string(NULL) AS review_comment_title",
            """CASE (order_id + j) % 4 WHEN 0 THEN 'late parcel' WHEN 1 THEN ''
               WHEN 2 THEN 'ok' END AS review_comment_message""",
            "delivered + make_dt_interval(j + 1) AS review_creation_date",
            "delivered + make_dt_interval(j + 3) AS review_answer_timestamp",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "if(p_partkey % 50 <> 0, p_type, NULL) AS product_category_name",
        "length(p_name) AS product_name_lenght",
        "length(p_name) * 10 AS product_description_lenght",
        "p_size % 5 AS product_photos_qty",
        "double(p_size * 100) AS product_weight_g",
        "double(p_size) AS product_length_cm",
        "double(p_size + 1) AS product_height_cm",
        "double(p_size + 2) AS product_width_cm",
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "part")
        .where("p_type IN ('ECONOMY', 'MEDIUM', 'PROMO', 'STANDARD')")
        .selectExpr(
            "p_type AS product_category_name",
            "concat(lower(p_type), '_en') AS product_category_name_english",
        )
        .distinct()
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    nations = read(spark, folder, "nation").selectExpr("n_nationkey AS s_nationkey", "n_name")
    return read(spark, folder, "supplier").join(nations, "s_nationkey").selectExpr(
        "s_suppkey AS seller_id",
        "int(s_nationkey * 100 + s_suppkey % 7) AS seller_zip_code_prefix",
        "concat('city_', s_nationkey, '_', s_suppkey % 3) AS seller_city",
        "n_name AS seller_state",
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    nations = read(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return read(spark, folder, "customer").join(nations, "c_nationkey").selectExpr(
        "int(c_nationkey * 100 + c_custkey % 7) AS geolocation_zip_code_prefix",
        "c_nationkey - 30D + (c_custkey % 100) / 1000D AS geolocation_lat",
        "c_nationkey - 60D - (c_custkey % 90) / 1000D AS geolocation_lng",
        "concat('city_', c_nationkey, '_', c_custkey % 7 % 3) AS geolocation_city",
        "n_name AS geolocation_state",
    )


def churn_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").selectExpr(
        "md5(string(c_custkey)) AS customer_unique_id",
        "(c_custkey * 7919 % 1000) / 1000D AS churn_probability",
        "int(c_custkey * 7919 % 1000 >= 500) AS predicted_label",
        "'fixture' AS model_name",
        "'2018-10-17 00:00:00' AS prediction_generated_at",
    )


def audit_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Measured calls as they reach the access log: one per event."""
    return read(spark, folder, "events").selectExpr(
        "*", "int(get_json_object(props, '$.k')) AS k"
    ).selectExpr(
        "ts AS timestamp",
        "concat('s', user_id % 20) AS session",
        "event_type AS function",
        """map('k', string(k), 'email', concat('u', user_id, '@mail.org'),
               'filter', if(k % 25 = 0, "x'; DROP TABLE t; --", 'plain')) AS params""",
        "bigint(k * 20) AS row_count",
        "value AS duration_ms",
        r"concat('  SELECT k\nFROM ', event_type, '\nWHERE k = ', k, '  ') AS sql",
        "if(event_type = 'error', 'error', 'success') AS status",
        "if(event_type = 'error', concat('failed ', event_id), NULL) AS error",
    )


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Personal columns to mask, one row per customer."""
    return read(spark, folder, "customer").selectExpr(
        "md5(string(c_custkey)) AS customer_unique_id",
        """CASE c_custkey % 17 WHEN 0 THEN 'no address' WHEN 1 THEN '' ELSE
           concat('user', c_custkey, '@', lower(c_mktsegment),
                  element_at(array('.co.uk', '.com', ''), int(c_custkey % 3 + 1))) END
           AS email""",
        """if(c_custkey % 19 = 0, '', concat('+', c_nationkey + 1, '-', c_custkey % 900 + 100,
              '-', lpad(string(c_custkey), 4, '0'))) AS phone""",
        """if(c_custkey % 23 = 0, '', concat(lower(c_mktsegment), ' da ',
              replace(c_name, '#', ' '))) AS name""",
        "concat('city_', c_nationkey) AS city",
    )
