"""The model graph: every model a lazy DataFrame built from the ones before it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from ..functions.keys import surrogate_key
from ..operators import audit, churn, customers, geography, kpis, orders, staging
from ..sources import fixtures, files, schemas

MODELS = (
    "stg_orders", "stg_customers", "stg_order_items", "stg_order_reviews",
    "stg_order_payments", "stg_products", "stg_sellers", "stg_geolocation", "int_orders",
    "int_customer_orders", "dim_customers", "fct_orders", "kpi_monthly", "churn_features",
    "mart_churn",
)


class Sources(Mapping):
    """Sources by name, each opened when it is first asked for."""

    def __init__(
        self, spark: SparkSession, openers: Mapping[str, Callable[[], DataFrame]],
        folder: str | None = None,
    ):
        self.spark, self.folder = spark, folder
        self._openers = dict(openers)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._openers[name]()
        return self._open[name]

    def __iter__(self):
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)


class Shop:
    """Sources in, models out. Nothing is computed until a model is used."""

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.src = sources

    @classmethod
    def over_fixtures(cls, spark: SparkSession, folder: str) -> Shop:
        """Sources derived from the supplied star-schema tables."""
        names = (*schemas.SOURCES, "churn_predictions", "audit_calls", "contacts")
        return cls(Sources(spark, {n: partial(getattr(fixtures, n), spark, folder) for n in names},
                           folder))

    @classmethod
    def over_csv(cls, spark: SparkSession, folder: str, file_names: Mapping[str, str]) -> Shop:
        """Sources read from CSV files with their declared columns.

        Only reviews hold free text, so all other files may be split while reading.
        """
        layouts = {**schemas.SOURCES, "churn_predictions": schemas.CHURN_PREDICTIONS}
        return cls(Sources(spark, {
            name: partial(files.read_csv, spark, f"{folder}/{file_names[name]}", ddl,
                          name == "order_reviews", typed=True)
            for name, ddl in layouts.items() if name in file_names
        }))

    @classmethod
    def over_tables(cls, spark: SparkSession, schema: str) -> Shop:
        """Sources that are tables or views under their raw names."""
        return cls(Sources(spark, {
            name: partial(spark.table, f"{schema}.{name}") for name in schemas.SOURCES
        }))

    # ---- staging

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.orders(self.src["orders"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.src["customers"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.order_items(self.src["order_items"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.order_payments(self.src["order_payments"])

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.order_reviews(self.src["order_reviews"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.products(self.src["products"], self.src["category_translation"])

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.sellers(self.src["sellers"])

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return geography.zip_centroids(self.src["geolocation"])

    # ---- intermediate

    @cached_property
    def int_orders(self) -> DataFrame:
        return orders.enriched(self.stg_orders, self.stg_order_payments, self.stg_order_reviews)

    @cached_property
    def dated_orders(self) -> DataFrame:
        """Order-grain part of the fact, for consumers that need neither person nor basket."""
        return orders.with_date_parts(self.int_orders)

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return customers.order_history(self.stg_customers, self.int_orders)

    # ---- marts

    @cached_property
    def dim_customers(self) -> DataFrame:
        centroids = geography.city_centroids(self.stg_geolocation)
        return customers.dimension(self.int_customer_orders, centroids)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return orders.fact(self.int_orders, self.stg_customers, self.stg_order_items)

    @cached_property
    def kpi_monthly(self) -> DataFrame:
        return kpis.monthly(self.dated_orders)

    @cached_property
    def churn_features(self) -> DataFrame:
        """History and signals come from one aggregate per account and one per person, over
        orders with their baskets. Nothing is stored: a consumer of a few columns prunes the rest,
        down to the payments, reviews or items that it does not need."""
        grain = self.int_orders.join(orders.item_rollup(self.stg_order_items), "order_id", "left")
        history = customers.order_history(self.stg_customers, grain, churn.signal_sums())
        people = customers.with_segments(churn.with_signals(history)).withColumn(
            "customer_sk", surrogate_key("customer_unique_id")
        )
        return churn.feature_columns(churn.eligible(people, self.int_orders))

    @cached_property
    def churn_labels(self) -> DataFrame:
        """Who is eligible and who has churned, from the dates of orders alone."""
        people = churn.eligible(self.int_customer_orders, self.int_orders)
        return people.select("customer_unique_id", "is_churned")

    @cached_property
    def mart_churn(self) -> DataFrame:
        return churn.scored_mart(self.src["churn_predictions"], self.dim_customers)

    # ---- bronze, silver, gold twins

    def bronze(self, source: str) -> DataFrame:
        return files.bronze_shape(source)(self.src[source])

    @cached_property
    def silver_orders(self) -> DataFrame:
        return orders.silver(
            self.bronze("orders"), self.bronze("order_payments"), self.bronze("order_reviews")
        )

    @cached_property
    def silver_customers(self) -> DataFrame:
        return customers.silver(self.bronze("customers"), self.silver_orders)

    @cached_property
    def silver_churn_features(self) -> DataFrame:
        return churn.silver_features(self.silver_customers, self.silver_orders)

    @cached_property
    def gold_monthly_kpis(self) -> DataFrame:
        return kpis.gold_monthly(self.silver_orders)

    @cached_property
    def gold_customer_segments(self) -> DataFrame:
        centroids = geography.city_centroids_by_point(self.src["geolocation"])
        return customers.gold_segments(self.silver_customers, centroids)

    def gold_delivery_by_state(self, min_orders: int = 100) -> DataFrame:
        """Orders are read twice, each time with few columns: for what is summed by state, and
        for the latest address of the people. Neither needs payments."""
        return kpis.gold_by_state(
            self.silver_orders, self.bronze("customers"), self.silver_customers, min_orders
        )

    # ---- access log

    @cached_property
    def audit_log(self) -> DataFrame:
        return audit.events(self.src["audit_calls"])

    def all_tables(self) -> dict[str, DataFrame]:
        """Sources and models under their public names."""
        tables = {f"src_{name}": df for name, df in self.src.items()}
        return tables | {name: getattr(self, name) for name in MODELS}
