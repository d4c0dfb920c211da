"""Declared data checks and their report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import ORDER_STATUSES, REVIEW_SCORES, RISK_TIERS

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class Checks:
    """What must hold for one table."""

    table: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.unique) + len(self.not_null) + len(self.accepted)


def _key(table: str, *columns: str, also: tuple[str, ...] = (), **accepted) -> Checks:
    return Checks(table, columns, (*columns, *also), accepted)


# The declared checks, sources first, then the models in build order.
SOURCE_CHECKS = (
    _key("src_orders", "order_id", also=("customer_id",)),
    _key("src_customers", "customer_id", also=("customer_unique_id",)),
    Checks("src_order_items", not_null=("order_id", "order_item_id")),
    Checks("src_order_reviews", not_null=("review_id", "order_id")),
    Checks("src_order_payments", not_null=("order_id",)),
    _key("src_products", "product_id"),
    _key("src_sellers", "seller_id"),
    _key("src_category_translation", "product_category_name"),
    Checks("src_geolocation", not_null=("geolocation_zip_code_prefix",)),
)
MODEL_CHECKS = (
    _key("stg_orders", "order_id", also=("customer_id",), order_status=ORDER_STATUSES),
    _key("stg_customers", "customer_id", also=("customer_unique_id",)),
    _key("stg_order_items", "order_item_sk"),
    Checks("stg_order_reviews", not_null=("review_id", "order_id"),
           accepted={"review_score": REVIEW_SCORES}),
    _key("stg_order_payments", "order_id"),
    _key("stg_products", "product_id"),
    _key("stg_sellers", "seller_id"),
    _key("int_orders", "order_id"),
    _key("churn_features", "customer_unique_id", also=("is_churned",), is_churned=(0, 1)),
    _key("int_customer_orders", "customer_unique_id"),
    _key("dim_customers", "customer_unique_id", "customer_sk"),
    _key("fct_orders", "order_id"),
    _key("kpi_monthly", "order_month"),
    _key("mart_churn", "customer_unique_id", also=("churn_probability", "churn_risk_tier"),
         churn_risk_tier=RISK_TIERS),
)
ALL_CHECKS = SOURCE_CHECKS + MODEL_CHECKS


def nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def outside(column: str, values: Sequence) -> Column:
    """Rows with another value; NULL passes."""
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def duplicated_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.where(present).groupBy(*columns).agg(F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )


def _row_tests(checks: Checks) -> list[tuple[str, str, Column]]:
    """The tests that a row fails or passes alone."""
    tests = [(c, NOT_NULL, F.col(c).isNull()) for c in checks.not_null if c not in checks.unique]
    return tests + [
        (c, ACCEPTED, F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in checks.accepted.items()
    ]


def _hashed(df: DataFrame, checks: Checks) -> DataFrame:
    """One row per key column (``_k``) and hash of its value (``_h``, NULL for none): rows, and
    failures of the row tests.

    A row appears once per key column, the first time with its failures, so the table is read
    once for all of its tests, and what moves is a hash per key, combined before it does.
    """
    failed = [e.cast("int").alias(f"f{i}") for i, (_, _, e) in enumerate(_row_tests(checks))]
    keys = F.array(*[
        F.struct(F.lit(i).alias("_k"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("_h"))
        for i, c in enumerate(checks.unique)
    ])
    rows = df.select(*failed, F.inline(keys))
    return rows.groupBy("_k", "_h").agg(
        F.count("*").alias("n"),
        *[F.sum(F.when(F.col("_k") == 0, F.col(f"f{i}"))).alias(f"f{i}") for i in range(len(failed))],
    )


def first_pass(df: DataFrame, checks: Checks) -> DataFrame:
    """All tests of a table in one scan: table_name, column_name, test, failures.

    For a key the failures of uniqueness are hashes that occur more than once. Where there are
    none, all values differ; where there are some, equal values are still to be told from equal
    hashes (``repeated_values``).
    """
    tests = [(c, t) for c, t, _ in _row_tests(checks)]
    if checks.unique:
        seen, k = _hashed(df, checks), F.col("_k")
        counted = [F.sum(f"f{i}") for i in range(len(tests))]
        for i, column in enumerate(checks.unique):
            tests += [(column, UNIQUE), (column, NOT_NULL)]
            counted += [
                F.count_if((k == i) & F.col("_h").isNotNull() & (F.col("n") > 1)),
                F.sum(F.when((k == i) & F.col("_h").isNull(), F.col("n"))),
            ]
    else:
        seen = df
        counted = [F.count_if(e) for _, _, e in _row_tests(checks)]
    row = seen.agg(*[c.alias(f"c{i}") for i, c in enumerate(counted)])
    listed = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"),
                 F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failures"))
        for i, (c, t) in enumerate(tests)
    ])
    return row.select(F.lit(checks.table).alias("table_name"), F.inline(listed))


def repeated_values(df: DataFrame, checks: Checks, column: str) -> int:
    """How many values of a key occur more than once, looking only at rows of repeated hashes."""
    place = checks.unique.index(column)
    suspects = _hashed(df, checks).where(
        (F.col("_k") == place) & F.col("_h").isNotNull() & (F.col("n") > 1)
    ).select("_h")
    rows = df.select(F.col(column)).withColumn("_h", F.xxhash64(column))
    return duplicated_keys(rows.join(suspects, "_h", "left_semi"), column).count()


def report(tables: Mapping[str, DataFrame], checks: Sequence[Checks] = ALL_CHECKS) -> DataFrame:
    """One row per declared check: table, column, test, failures, passed.

    One job scans every table once. Only a key with repeated hashes is looked at again, so the
    report is made when this is called; the driver sees one row per check.
    """
    by_table = {c.table: c for c in checks}
    found = reduce(
        DataFrame.unionByName, [first_pass(tables[c.table], c) for c in checks]
    ).collect()
    rows = []
    for r in found:
        failures = r.failures
        if r.test == UNIQUE and failures:
            failures = repeated_values(tables[r.table_name], by_table[r.table_name], r.column_name)
        rows.append((r.table_name, r.column_name, r.test, failures, failures == 0))
    some = next(iter(tables.values()))
    return some.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, test string, failures bigint, passed boolean"
    )


class DataQualityError(RuntimeError):
    """A declared check failed; dependants must not be built."""


def require(tables: Mapping[str, DataFrame], checks: Sequence[Checks] = ALL_CHECKS) -> None:
    """Raise with table, column and count of every failed check."""
    failed = report(tables, checks).where("NOT passed").collect()  # one row per failed check
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed]
        raise DataQualityError("; ".join(sorted(lines)))
