"""Monthly indicators as mergeable sums, stored by month and rebuilt a month at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.kpis import ADDENDS, merged_sums, monthly_from_sums, monthly_sums
from ..sources.tables import replace_partitions

#: Name of the partition column: the month as yyyy-MM.
MONTH = "month_key"
STORED = "order_month timestamp_ntz, " + ", ".join(f"{a} bigint" for a in ADDENDS)


def build(orders: DataFrame, path: str) -> None:
    """Store the sums of all months, one partition each."""
    sums = monthly_sums(orders).withColumn(MONTH, F.date_format("order_month", "yyyy-MM"))
    sums.repartition(MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def refresh(orders: DataFrame, path: str, months: Iterable[dt.datetime]) -> None:
    """Rebuild the given months from the orders as they are now; other partitions stay untouched.

    Only orders of these months are read, where the source can filter by month. A month that has
    no delivered order any more is stored with sums of 0 and disappears from the indicators.
    """
    spark = orders.sparkSession
    listed = sorted(set(months))
    if not listed:
        return
    fresh = monthly_sums(orders.where(F.col("order_month").isin(listed)))
    zeros = [F.lit(0).cast("bigint").alias(a) for a in ADDENDS]
    given = spark.createDataFrame([(m,) for m in listed], "order_month timestamp_ntz")
    both = fresh.unionByName(given.select("order_month", *zeros))
    sums = both.groupBy("order_month").agg(*[F.sum(a).alias(a) for a in ADDENDS])
    replace_partitions(
        sums.withColumn(MONTH, F.date_format("order_month", "yyyy-MM")), path, [MONTH]
    )


def changed_months(before: DataFrame, after: DataFrame, version: str) -> list[dt.datetime]:
    """Months with an order that is new, gone, or of another version; from keys and versions.

    An order that moved counts for both of its months. As many rows come to the driver as there
    are months.
    """
    old, new = (
        df.select("order_id", F.col("order_month").alias(f"_{side}"),
                  F.col(version).alias(f"_{side}_version"))
        for df, side in ((before, "old"), (after, "new"))
    )
    met = old.join(new, "order_id", "full").where(
        "NOT (_old_version <=> _new_version AND _old <=> _new)"
    )
    months = met.select(F.explode(F.array("_old", "_new")).alias("m")).where("m IS NOT NULL")
    return [r.m for r in months.distinct().collect()]


def indicators(spark: SparkSession, path: str) -> DataFrame:
    """``kpi_monthly`` from the stored sums."""
    return monthly_from_sums(merged_sums(spark.read.schema(STORED).parquet(path)))
