"""CSV and JSON-lines files: reading with declared columns, shaping, ingesting, writing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import inference, quoted, schemas
from .tables import write_table

Shape = Callable[[DataFrame], DataFrame]
#: Layout of timestamps in the files.
SECONDS = "yyyy-MM-dd HH:mm:ss"
#: How files are written that are read once and dropped. A packed file is read by one task, so its
#: rows are limited.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


def read_csv(
    spark: SparkSession, path: str, ddl: str, multi_line: bool = True, typed: bool = False
) -> DataFrame:
    """CSV with header, quotes doubled inside quotes.

    Columns come as text, for shaping with ``try_cast``, unless ``typed``. ``multi_line``
    allows line breaks inside quotes; large files are split either way, but finding out how each
    split starts takes two more passes, so switch it off for sources without free text.
    """
    schema = schemas.struct(ddl) if typed else schemas.as_text(ddl)
    if multi_line:
        return quoted.read(spark, path, schema, timestampNTZFormat=SECONDS)
    return (
        spark.read.schema(schema)
        .options(header=True, quote='"', escape='"', timestampNTZFormat=SECONDS).csv(path)
    )


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header whose types come from all of its values (``inference``)."""
    texts = spark.read.schema(inference.header_schema(spark, path)).options(
        header=True, quote='"', escape='"').csv(path)
    types = inference.column_types({"file": texts})
    return (
        spark.read.schema(inference.schema_of(types))
        .options(header=True, quote='"', escape='"', timestampNTZFormat=SECONDS).csv(path)
    )


def write_csv(df: DataFrame, path: str, **layout) -> None:
    """``layout`` are further options of the writer, such as ``PACKED``."""
    df.write.options(header=True, quote='"', escape='"',
                     timestampNTZFormat=SECONDS, **layout).csv(path)


# ---- shaping of raw columns ----------------------------------------------------------------
# Per source the (raw column, type, new name) kept at ingest.

SHAPES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "orders": (
        ("order_id", "", "order_id"),
        ("customer_id", "", "customer_id"),
        ("order_status", "", "order_status"),
        ("order_purchase_timestamp", "timestamp_ntz", "order_purchase_timestamp"),
        ("order_approved_at", "timestamp_ntz", "order_approved_at"),
        ("order_delivered_carrier_date", "timestamp_ntz", "order_delivered_carrier_date"),
        ("order_delivered_customer_date", "timestamp_ntz", "order_delivered_customer_date"),
        ("order_estimated_delivery_date", "timestamp_ntz", "order_estimated_delivery_date"),
    ),
    "customers": (
        ("customer_id", "", "customer_id"),
        ("customer_unique_id", "", "customer_unique_id"),
        ("customer_zip_code_prefix", "int", "zip_code_prefix"),
        ("customer_city", "", "city"),
        ("customer_state", "", "state"),
    ),
    "order_items": (
        ("order_id", "", "order_id"),
        ("order_item_id", "", "order_item_id"),
        ("product_id", "", "product_id"),
        ("seller_id", "", "seller_id"),
        ("shipping_limit_date", "timestamp_ntz", "shipping_limit_date"),
        ("price", "double", "price"),
        ("freight_value", "double", "freight_value"),
    ),
    "order_payments": (
        ("order_id", "", "order_id"),
        ("payment_sequential", "int", "payment_sequential"),
        ("payment_type", "", "payment_type"),
        ("payment_installments", "int", "payment_installments"),
        ("payment_value", "double", "payment_value"),
    ),
    "order_reviews": (
        ("review_id", "", "review_id"),
        ("order_id", "", "order_id"),
        ("review_score", "int", "review_score"),
        ("review_comment_title", "", "review_comment_title"),
        ("review_comment_message", "", "review_comment_message"),
        ("review_creation_date", "timestamp_ntz", "review_created_at"),
        ("review_answer_timestamp", "timestamp_ntz", "review_answered_at"),
    ),
    "products": (
        ("product_id", "", "product_id"),
        ("product_category_name", "", "category_name_pt"),
        ("product_name_lenght", "int", "name_length"),
        ("product_description_lenght", "int", "description_length"),
        ("product_photos_qty", "int", "photos_qty"),
        ("product_weight_g", "double", "weight_g"),
        ("product_length_cm", "double", "product_length_cm"),
        ("product_height_cm", "double", "product_height_cm"),
        ("product_width_cm", "double", "product_width_cm"),
    ),
    "sellers": (
        ("seller_id", "", "seller_id"),
        ("seller_zip_code_prefix", "int", "zip_code_prefix"),
        ("seller_city", "", "city"),
        ("seller_state", "", "state"),
    ),
    "geolocation": (
        ("geolocation_zip_code_prefix", "int", "zip_code_prefix"),
        ("geolocation_lat", "double", "lat"),
        ("geolocation_lng", "double", "lng"),
        ("geolocation_city", "", "city"),
        ("geolocation_state", "", "state"),
    ),
    "category_translation": (
        ("product_category_name", "", "product_category_name"),
        ("product_category_name_english", "", "product_category_name_english"),
    ),
}


def bronze_shape(source: str) -> Shape:
    """Select, cast and rename the raw columns of one source; bad values become NULL."""
    def shape(df: DataFrame) -> DataFrame:
        return df.select([
            (F.col(raw).try_cast(kind) if kind else F.col(raw)).alias(name)
            for raw, kind, name in SHAPES[source]
        ])
    return shape


def restored_names(source: str) -> dict[str, str]:
    """New name to raw name, for the views that offer the raw layout again."""
    return {name: raw for raw, _, name in SHAPES[source] if name != raw}


def with_lineage(df: DataFrame, file_name: str | None = None, stamp: str = "_ingested_at"):
    """Where the rows came from and when."""
    if file_name is not None:
        df = df.withColumn("_source_file", F.lit(file_name))
    return df.withColumn(stamp, F.current_timestamp())


def ingest_csv(
    spark: SparkSession, folder: str, file_name: str, ddl: str, table: str,
    shape: Shape | None = None, path: str | None = None, table_format: str = "parquet",
    multi_line: bool = False, codec: str | None = None,
) -> int:
    """Read one CSV, shape it, add lineage and replace the table; returns its row count.

    ``multi_line`` is for texts with line breaks; such files are split as well (``quoted``).
    """
    df = read_csv(spark, f"{folder.rstrip('/')}/{file_name}", ddl, multi_line)
    if shape is not None:
        df = df.transform(shape)
    return write_table(with_lineage(df, file_name), table, path, table_format, codec=codec)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CHURN_PREDICTIONS, multi_line=False, typed=True)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of the access log; lines that are not valid records are skipped."""
    return (
        spark.read.schema(schemas.struct(schemas.AUDIT_LOG))
        .option("mode", "DROPMALFORMED").json(path)
        .where("event = 'data_access'")
    )


def append_audit(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)
