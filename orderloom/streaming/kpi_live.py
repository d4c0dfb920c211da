"""Monthly indicators that keep up with orders whose status and values change.

Of every order it is stored what it last added to which month. News of an order takes that back and
adds the new values, so a batch becomes a few signed sums per month; indicators are quotients of
added sums and are formed when they are read. Old news, and news told twice, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from ..operators.kpis import ADDENDS, DELIVERED, merged_sums, order_addends
from . import runs

KNOWN = ("version", "month", *ADDENDS)
#: A month in days since 1970; an order that counts nowhere has none.
NOWHERE = -(2**31)
SUMS = StructType([
    StructField("order_month", TimestampNTZType()), *[StructField(a, LongType()) for a in ADDENDS]
])
#: Batches between two totals.
FOLD_EVERY = 20


def order_events(orders: DataFrame, version: Column) -> DataFrame:
    """News of orders: key, version, status, month and what the order adds if it is delivered."""
    addends = order_addends()
    return orders.select(
        "order_id", version.cast("long").alias("version"), "order_status", "order_month",
        *[addends[a].alias(a) for a in ADDENDS],
    )


def changes(events: DataFrame) -> DataFrame:
    """What a stream of news (``order_events``) says of each order: version, month and sums.

    News without a version or key are left out; news of an order that is not delivered, or of no
    month, say that it counts nowhere.
    """
    counted = (F.col("order_status") == DELIVERED) & F.col("order_month").isNotNull()
    month = F.when(counted, F.unix_date(F.to_date("order_month")))
    return events.where("order_id IS NOT NULL AND version IS NOT NULL").select(
        "order_id", "version", F.coalesce(month, F.lit(NOWHERE)).alias("month"), *ADDENDS
    )


def _newest(fresh: Column | None = None) -> Column:
    """Of an order's rows the one of the newest version, of equal versions any."""
    row = F.struct(*KNOWN)
    return F.max_by(row, F.col("version")) if fresh is None else F.max_by(
        F.when(fresh, row), F.when(fresh, F.col("version")))


def _known(spark: SparkSession, table: str, batch: int, schema: StructType) -> DataFrame:
    """What batches before this one stored of the orders: the last state and the news after it."""
    return runs.read_runs(spark, table, _chosen(spark, table, batch - 1, "known", "news"), schema)


def _kept(news: DataFrame) -> StructType:
    """Layout of what is stored of an order."""
    return StructType([news.schema[c] for c in ("order_id", *KNOWN)])


def _signed(spark: SparkSession, news: DataFrame, table: str, batch: int) -> DataFrame:
    """Store the news that are newer than what earlier batches stored of their order, and return
    the sums that they add and those that they take back."""
    known = _known(spark, table, batch, _kept(news))
    fresh = F.col("_fresh")
    met = known.withColumn("_fresh", F.lit(False)).unionByName(
        news.withColumn("_fresh", F.lit(True))
    ).groupBy("order_id").agg(_newest(~fresh).alias("before"), _newest(fresh).alias("after"))
    newer = F.col("before").isNull() | (F.col("after.version") > F.col("before.version"))
    changed = met.where(F.col("after").isNotNull() & newer).select(
        "order_id", "after.*", "before")
    runs.write_run(changed, table, "news", batch)
    stored = runs.read_runs(spark, table, [("news", batch)], changed.schema)
    added = stored.select("month", *ADDENDS)
    back = stored.select(
        "before.month", *[(-F.col(f"before.{a}")).alias(a) for a in ADDENDS])
    return added.unionByName(back).where(F.col("month") != NOWHERE)


def _chosen(
    spark: SparkSession, table: str, upto: int | None = None, whole: str = "total",
    part: str = "delta",
) -> list[tuple[str, int]]:
    """The newest total and the deltas after it."""
    reached = lambda kind: [r for r in runs.runs(spark, table, kind) if upto is None or r <= upto]
    total = reached(whole)[-1:]
    after = total[0] if total else -1
    return [(whole, r) for r in total] + [(part, r) for r in reached(part) if r > after]


def current(spark: SparkSession, table: str, upto: int | None = None) -> DataFrame:
    """Sums of every month as the last batch left them."""
    return merged_sums(runs.read_runs(spark, table, _chosen(spark, table, upto), SUMS))


def follow(
    changed: DataFrame, table: str, checkpoint: str, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Process what has arrived and stop; call again for newer news.

    A batch writes its signed sums, and the news of orders that they come from, under its number,
    so a batch that is repeated after a failure replaces what it wrote. Every ``fold_every``
    batches the sums so far are written as a total, and the newest row of every order as what is
    known; readers need the newest total and the deltas after it, and what the total before it has
    made superfluous is deleted, so neither reading nor listing grows with the number of batches.
    """
    def write(news: DataFrame, batch: int) -> None:
        spark = news.sparkSession
        month = F.date_from_unix_date("month").cast("timestamp_ntz")
        signed = _signed(spark, news, table, batch)
        runs.write_run(
            merged_delta(signed.withColumn("order_month", month)), table, "delta", batch)
        if batch % fold_every == fold_every - 1:
            runs.write_run(current(spark, table, batch), table, "total", batch)
            kept = _kept(news)
            known = _known(spark, table, batch, kept).unionByName(
                runs.read_runs(spark, table, [("news", batch)], kept))
            runs.write_run(
                known.groupBy("order_id").agg(_newest().alias("row")).select("order_id", "row.*"),
                table, "known", batch)
            # a repeat of this batch needs the state before it
            for kind, last in (("delta", 0), ("total", 0), ("news", 0), ("known", 1)):
                for old in runs.runs(spark, table, kind):
                    if old <= batch - fold_every - last:
                        runs.drop_run(spark, table, kind, old)

    return (
        changed.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def merged_delta(signed: DataFrame) -> DataFrame:
    """Signed sums per month; a month whose orders cancel out may still change in value."""
    return signed.groupBy("order_month").agg(*[F.sum(a).alias(a) for a in ADDENDS])
