"""Storing the layers: model tables with their checks, and the bronze, silver, gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators import churn, customers, geography, kpis, orders, quality
from ..session import collected
from ..sources import files, schemas, tables
from .shop import Shop

VIEWS = (
    "stg_orders", "stg_customers", "stg_order_items", "stg_order_reviews",
    "stg_order_payments", "stg_products", "stg_sellers", "stg_geolocation", "int_orders",
    "int_customer_orders", "churn_features",
)


def build_marts(
    spark: SparkSession, shop: Shop, schema: str, folder: str | None = None,
    names: Mapping[str, str] | None = None, check: bool = True, table_format: str = "parquet",
    fact_buckets: int | None = None,
) -> dict[str, int]:
    """Publish staging and intermediate models as views and store the marts as tables.

    Sources and staging are checked before anything is stored, the marts afterwards. ``names``
    renames marts; ``fact_buckets`` stores the fact bucketed by order for joins without a
    shuffle. Returns the stored row counts.
    """
    tables.create_schema(spark, schema)
    names = dict(names or {})
    every = shop.all_tables()
    early = [c for c in quality.ALL_CHECKS if c.table.startswith(("src_", "stg_"))]
    if check:
        quality.require(every, early)

    stored: dict[str, int] = {}

    def store(model: str, df: DataFrame, **layout) -> DataFrame:
        name = f"{schema}.{names.get(model, model)}"
        path = f"{folder}/{names.get(model, model)}" if folder else None
        stored[model] = tables.write_table(df, name, path, table_format, **layout)
        every[model] = spark.table(name)
        return every[model]

    people = store("dim_customers", shop.dim_customers)
    layout = {"bucket_by": (fact_buckets, "order_id")} if fact_buckets else {}
    fact = store("fct_orders", shop.fct_orders, **layout)
    store("kpi_monthly", kpis.monthly(fact))
    every["churn_features"] = churn.features(fact, people)
    if "churn_predictions" in shop.src:
        store("mart_churn", churn.scored_mart(shop.src["churn_predictions"], people))
    else:
        every.pop("mart_churn", None)
    for view in VIEWS:
        tables.publish_view(every[view], view)
    if check:
        late = [c for c in quality.ALL_CHECKS if c not in early and c.table in every]
        quality.require(every, late)
    return stored


#: Layers in the order in which they are built, and jobs that are submitted at a time.
LAYERS, AT_ONCE = ("bronze", "silver", "gold"), 3
#: Compression of the layers, which hold every source once more.
CODEC = "zstd"


def side_by_side(jobs: Sequence[Callable]) -> list:
    """Results of jobs that do not need each other: the last tasks of one leave no core idle."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(lambda job: job(), jobs))


def build_layers(
    spark: SparkSession, csv_folder: str, file_names: Mapping[str, str],
    schemas_by_layer: Mapping[str, str], folder: str | None = None,
    table_format: str = "parquet", last: str = "gold",
    ingested: Callable[[str], None] = lambda source: None,
) -> dict[str, int]:
    """CSV files to bronze, silver and gold tables; every layer reads the stored one below.

    ``last`` is the last layer to build, with all of its tables and all layers below.
    ``ingested`` is told each source whose bronze table is stored: its file is not read again.
    """
    counts: dict[str, int] = {}
    wanted = LAYERS[:LAYERS.index(last) + 1]

    def place(layer: str, name: str) -> tuple[str, str | None]:
        return f"{schemas_by_layer[layer]}.{name}", f"{folder}/{layer}/{name}" if folder else None

    def store(layer: str, name: str, df: DataFrame, stamp: str) -> DataFrame:
        table, path = place(layer, name)
        counts[name] = tables.write_table(
            files.with_lineage(df, stamp=stamp), table, path, table_format, codec=CODEC
        )
        return spark.table(table).drop(stamp)

    for layer in wanted:
        tables.create_schema(spark, schemas_by_layer[layer])

    def ingest(source: str, ddl: str) -> DataFrame:
        table, path = place("bronze", f"raw_{source}")
        counts[f"raw_{source}"] = files.ingest_csv(
            spark, csv_folder, file_names[source], ddl, table, files.bronze_shape(source), path,
            table_format, multi_line=source == "order_reviews", codec=CODEC,
        )
        ingested(source)
        return spark.table(table)

    stored = side_by_side([partial(ingest, *item) for item in schemas.SOURCES.items()])
    bronze = dict(zip(schemas.SOURCES, stored))
    if "silver" not in wanted:
        return counts

    silver_orders = store(
        "silver", "silver_orders",
        orders.silver(bronze["orders"], bronze["order_payments"], bronze["order_reviews"]),
        "_transformed_at",
    )
    collected(spark)
    silver_customers = store(
        "silver", "silver_customers",
        customers.silver(bronze["customers"], silver_orders), "_transformed_at",
    )
    collected(spark)
    store("silver", "silver_churn_features",
          churn.silver_features(silver_customers, silver_orders), "_transformed_at")
    if "gold" not in wanted:
        return counts

    centroids = geography.city_centroids_by_point(
        bronze["geolocation"].withColumnsRenamed(files.restored_names("geolocation"))
    )
    golden = {
        "gold_monthly_kpis": kpis.gold_monthly(silver_orders),
        "gold_customer_segments": customers.gold_segments(silver_customers, centroids),
        "gold_delivery_by_state":
            kpis.gold_by_state(silver_orders, bronze["customers"], silver_customers),
    }
    side_by_side([partial(store, "gold", name, df, "_updated_at") for name, df in golden.items()])
    return counts
