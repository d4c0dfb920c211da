"""Catalog tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Make sure a schema exists, in its own folder if one is given."""
    args, where = {"name": name}, ""
    if location is not None:
        args["location"], where = location, " LOCATION :location"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name){where}", args=args)


def table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    return spark.table(f"{schema}.{name}" if schema else name)


def write_table(
    df: DataFrame, name: str, path: str | None = None, table_format: str = "parquet",
    partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None,
    codec: str | None = None,
) -> int:
    """Replace a table, layout included; returns the rows written.

    The count is observed while writing, so the table is not read again. ``bucket_by`` stores
    rows ready for joins on that key without a shuffle; they are dealt out by the key first, so
    each bucket is one sorted file however many tasks there were. ``codec`` compresses the files
    by another codec than the session's.
    """
    counted = Observation()
    if bucket_by is not None:
        df = df.repartition(*bucket_by)
    writer = (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").format(table_format).option("overwriteSchema", "true")
    )
    if path is not None:
        writer = writer.option("path", path)
    if codec is not None:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    return counted.get["rows"]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace those partitions of a stored table that occur in the rows; the others stay."""
    (
        df.repartition(*partition_by).write.mode("overwrite").partitionBy(*partition_by)
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    )


#: Sources with rows per order, which meet on that key.
BY_ORDER = ("orders", "order_payments", "order_reviews", "order_items")


#: Rows of one source in a bucket, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1_000_000, 8


def buckets_for(sources: Mapping[str, DataFrame], rows: int = BUCKET_ROWS) -> int:
    """Buckets in which the largest source by order has about so many rows each."""
    most = max((sources[name].count() for name in BY_ORDER if name in sources), default=0)
    return max(LEAST_BUCKETS, -(-most // rows))


def store_by_order(
    sources: Mapping[str, DataFrame], schema: str, buckets: int | None = None,
    folder: str | None = None,
) -> dict[str, int]:
    """Store sources so that orders, payments, reviews and items meet without a shuffle.

    These four are bucketed alike by ``order_id``; a bucket of each is read by the same task, so
    the number of buckets follows the rows (``buckets_for``) unless it is given. All other
    sources are stored plainly. Row counts come back.
    """
    buckets = buckets or buckets_for(sources)
    counts = {}
    for name, df in sources.items():
        layout = {"bucket_by": (buckets, "order_id")} if name in BY_ORDER else {}
        path = f"{folder}/{name}" if folder else None
        counts[name] = write_table(df, f"{schema}.{name}", path, **layout)
    return counts


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Layers that are views stay unevaluated."""
    df.createOrReplaceTempView(name)
    return df


def renamed_view(df: DataFrame, names: Mapping[str, str], view: str) -> DataFrame:
    """Offer a cleaned table under its raw column names, lineage columns left out."""
    raw = df.drop(*[c for c in df.columns if c.startswith("_")]).withColumnsRenamed(dict(names))
    return publish_view(raw, view)


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Every table and view with its columns in order.

    The session's temporary views belong to no schema, so a named schema is listed without them.
    """
    rows = [
        (t.name, position, c.name)
        for t in spark.catalog.listTables(schema) if schema is None or not t.isTemporary
        for position, c in enumerate(
            spark.table(t.name if t.isTemporary else f"{t.namespace[0]}.{t.name}").schema
        )
    ]
    columns = spark.createDataFrame(rows, "table_name string, position int, column_name string")
    return describe_columns(columns).orderBy("table_name")


def describe_columns(columns: DataFrame) -> DataFrame:
    """One row per table: its column names joined in order of position."""
    joined = F.expr("listagg(column_name, ', ') WITHIN GROUP (ORDER BY position)")
    return columns.groupBy("table_name").agg(joined.alias("columns"))
