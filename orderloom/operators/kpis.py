"""Service indicators: monthly, by region and by other dimensions.

Every indicator is a quotient of additive sums, so the sums are formed once per small group,
merged as often as needed and divided at the very end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import date_of, month_label
from ..functions.numeric import (
    exact, exact_mean, exact_sum, money_mean, money_part, money_sum, money_total, money_whole,
    percent, ratio, rounded,
)
from ..functions.segments import delivery_bucket

DELIVERED = "delivered"


def with_status(orders: DataFrame, *statuses: str) -> DataFrame:
    status = F.col("order_status")
    return orders.where(status == statuses[0] if len(statuses) == 1 else status.isin(*statuses))


def share_of_total(counted: DataFrame, count: str, out: str, digits: int) -> DataFrame:
    """Percentage of the overall count; ``counted`` is already one row per class."""
    total = F.sum(count).over(Window.partitionBy())
    return counted.withColumn(out, percent(ratio(count, total), digits))


# ---- monthly ------------------------------------------------------------------------------


def _volume_columns() -> list[Column]:
    return [
        F.count_if("has_review_comment").alias("orders_with_comment"),
        F.count_if(F.col("review_score") == 1).alias("low_score_orders"),
        F.count_if("used_voucher").alias("voucher_orders"),
    ]


def _money_columns() -> list[Column]:
    return [
        rounded(money_mean("total_payment_value"), 2).alias("avg_order_value_brl"),
        rounded(money_sum("total_payment_value"), 2).alias("total_gmv_brl"),
    ]


def _monthly(orders: DataFrame, counted: Column, on_time: Column) -> DataFrame:
    score = F.col("review_score")
    return (
        with_status(orders, DELIVERED)
        .groupBy("order_month")
        .agg(
            counted.alias("total_orders"),
            rounded(F.avg(score), 3).alias("avg_review_score"),
            rounded(F.avg("days_to_deliver"), 2).alias("avg_days_to_deliver"),
            rounded(ratio(F.count_if(score >= 4), F.count(score)), 4).alias("csat_rate"),
            rounded(ratio(on_time, F.count("order_id")), 4).alias("on_time_rate"),
            *_money_columns(),
            *_volume_columns(),
        )
        .orderBy("order_month")
    )


def monthly(fact: DataFrame) -> DataFrame:
    """Delivered orders per calendar month.

    Orders are counted distinctly. Coming from the enriched orders, which are already
    partitioned by ``order_id``, that adds no shuffle.
    """
    return _monthly(fact, F.count_distinct("order_id"), F.count_if(F.col("delivered_on_time")))


def gold_monthly(silver_orders: DataFrame) -> DataFrame:
    """Twin of ``monthly``: plain order count, and no rate in a month without any date."""
    on_time = F.sum(F.col("delivered_on_time").cast("int"))
    return _monthly(silver_orders, F.count("order_id"), on_time)


# ---- the same indicators from additive sums, which can be merged, and taken back again


def _one_if(condition: Column | str) -> Column:
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(condition.cast("long"), F.lit(0).cast("long"))


def order_addends() -> dict[str, Column]:
    """What one order adds to its month: whole numbers, so sums are exact in any order."""
    or_zero = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    value = "total_payment_value"
    return {
        "orders": F.lit(1).cast("long"),
        "score_sum": or_zero(F.col("review_score")),
        "scored": _one_if("review_score IS NOT NULL"),
        "high_scores": _one_if("review_score >= 4"),
        "low_scores": _one_if("review_score = 1"),
        "days_sum": or_zero(F.col("days_to_deliver")),
        "dated": _one_if("days_to_deliver IS NOT NULL"),
        "on_time": _one_if("delivered_on_time"),
        "value_whole": or_zero(money_whole(value)),
        "value_part": or_zero(money_part(value)),
        "valued": _one_if(f"{value} IS NOT NULL"),
        "commented": _one_if("has_review_comment"),
        "vouchers": _one_if("used_voucher"),
    }


ADDENDS = (
    "orders", "score_sum", "scored", "high_scores", "low_scores", "days_sum", "dated", "on_time",
    "value_whole", "value_part", "valued", "commented", "vouchers",
)


def monthly_sums(orders: DataFrame) -> DataFrame:
    """Additive sums per month over rows of one order each."""
    addends = order_addends()
    return with_status(orders, DELIVERED).groupBy("order_month").agg(
        *[F.sum(addends[a]).alias(a) for a in ADDENDS]
    )


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums of several parts, some of which may take others back; empty months disappear."""
    added = sums.groupBy("order_month").agg(*[F.sum(a).alias(a) for a in ADDENDS])
    return added.where("orders <> 0")


def monthly_from_sums(sums: DataFrame) -> DataFrame:
    """The columns of ``monthly`` from one row of sums per month."""
    value = money_total("value_whole", "value_part")
    some = F.col("valued") > 0
    return sums.select(
        "order_month",
        F.col("orders").alias("total_orders"),
        rounded(ratio("score_sum", "scored"), 3).alias("avg_review_score"),
        rounded(ratio("days_sum", "dated"), 2).alias("avg_days_to_deliver"),
        rounded(ratio("high_scores", "scored"), 4).alias("csat_rate"),
        rounded(ratio("on_time", "orders"), 4).alias("on_time_rate"),
        rounded(ratio(value, "valued"), 2).alias("avg_order_value_brl"),
        rounded(F.when(some, value), 2).alias("total_gmv_brl"),
        F.col("commented").alias("orders_with_comment"),
        F.col("low_scores").alias("low_score_orders"),
        F.col("vouchers").alias("voucher_orders"),
    ).orderBy("order_month")


def monthly_view(kpi: DataFrame) -> DataFrame:
    """Presentation of the monthly table: percentages and thousands."""
    return kpi.select(
        date_of("order_month").alias("month"),
        "total_orders",
        percent("csat_rate", 2).alias("csat_pct"),
        percent("on_time_rate", 2).alias("on_time_pct"),
        "avg_review_score",
        rounded(F.col("total_gmv_brl") / 1000.0, 1).alias("gmv_k_brl"),
        "avg_days_to_deliver",
        "low_score_orders",
    ).orderBy("month")


def monthly_trend(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        month_label("order_month").alias("month"),
        "total_orders",
        percent("csat_rate").alias("csat_pct"),
        percent("on_time_rate").alias("on_time_pct"),
        rounded(F.col("total_gmv_brl") / 1000.0, 1).alias("gmv_k_brl"),
    ).orderBy("month")


def header(kpi: DataFrame, weighted: bool = False) -> DataFrame:
    """Totals over all months. Rates are plain means of the months unless ``weighted``."""
    def mean(name: str) -> Column:
        if not weighted:
            return exact_mean(name)
        known = F.when(F.col(name).isNotNull(), F.col("total_orders"))
        return ratio(F.sum(exact(name) * known), F.sum(known))

    return kpi.agg(
        F.sum("total_orders").alias("total_orders"),
        percent(mean("csat_rate")).alias("avg_csat_pct"),
        percent(mean("on_time_rate")).alias("avg_on_time_pct"),
        rounded(mean("avg_review_score"), 2).alias("avg_review_score"),
        rounded(exact_sum("total_gmv_brl") / 1e6, 2).alias("total_gmv_m_brl"),
    )


# ---- by dimension -------------------------------------------------------------------------

SUMS = ("n", "days", "n_days", "delta", "n_delta", "on_time", "score", "n_score", "happy")


def _order_sums(orders: DataFrame, *by: str) -> DataFrame:
    score = F.col("review_score")
    return orders.groupBy(*by).agg(
        F.count("order_id").alias("n"),
        F.sum("days_to_deliver").alias("days"),
        F.count("days_to_deliver").alias("n_days"),
        F.sum("delivery_delta_days").alias("delta"),
        F.count("delivery_delta_days").alias("n_delta"),
        F.sum(F.col("delivered_on_time").cast("int")).alias("on_time"),
        F.sum(score).alias("score"),
        F.count(score).alias("n_score"),
        F.count_if(score >= 4).alias("happy"),
    )


def _merge_sums(sums: DataFrame, *by: str) -> DataFrame:
    return sums.groupBy(*by).agg(*[F.sum(name).alias(name) for name in SUMS])


def _performance(
    sums: DataFrame, dimension: Column, names: Sequence[str], digits: Sequence[int],
    undated_is_late: bool = True,
) -> DataFrame:
    """Divide the sums: count, days, delta, on-time share, score, satisfied share."""
    on_time = F.coalesce("on_time", F.lit(0)) if undated_is_late else F.col("on_time")
    values = (
        F.col("n"),
        rounded(ratio("days", "n_days"), digits[0]),
        rounded(ratio("delta", "n_delta"), digits[1]),
        percent(ratio(on_time, "n")),
        rounded(ratio("score", "n_score"), digits[2]),
        percent(ratio("happy", "n_score")),
    )
    return sums.select(dimension, *[v.alias(name) for v, name in zip(values, names)])


PERFORMANCE_COLUMNS = (
    "total_orders", "avg_days_to_deliver", "avg_delta_vs_estimate", "on_time_pct",
    "avg_review_score", "csat_pct",
)
DASHBOARD_COLUMNS = ("orders", "avg_days", "avg_delta", "on_time_pct", "avg_review", "csat_pct")


def _sums_by_state(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """State is the one of the person's latest address.

    Orders are summed per person first: the shuffle is the one the join needs, and a person
    with very many orders reaches the join as a single row.
    """
    per_person = _order_sums(with_status(fact, DELIVERED), "customer_sk")
    states = dimension.select("customer_sk", "state").where("state IS NOT NULL")
    return _merge_sums(per_person.join(states, "customer_sk"), "state")


def by_dimension(
    fact: DataFrame, group_by: str, dimension: DataFrame | None = None
) -> DataFrame:
    """Unfiltered performance table of one dimension; ``state`` needs the dimension table."""
    if group_by == "state":
        sums = _sums_by_state(fact, dimension)
    else:
        delivered = with_status(fact, DELIVERED).where(F.col(group_by).isNotNull())
        sums = _order_sums(delivered, group_by)
    return _performance(
        sums, F.col(group_by).alias("dimension"), PERFORMANCE_COLUMNS, (2, 2, 3)
    )


def at_least(groups: DataFrame, count: str, minimum: int) -> DataFrame:
    return groups.where(F.col(count) >= minimum)


def state_dashboard(fact: DataFrame, dimension: DataFrame, min_orders: int = 100) -> DataFrame:
    table = _performance(
        _sums_by_state(fact, dimension), F.col("state"), DASHBOARD_COLUMNS, (1, 1, 2)
    )
    return at_least(table, "orders", min_orders).orderBy(F.desc_nulls_last("avg_days"), "state")


def gold_by_state(
    silver_orders: DataFrame, customers: DataFrame, silver_customers: DataFrame,
    min_orders: int = 100,
) -> DataFrame:
    """Delivered silver orders by state, summed per account and per person on the way."""
    accounts = customers.select("customer_id", "customer_unique_id")
    states = silver_customers.select("customer_unique_id", "state").where("state IS NOT NULL")
    per_account = _order_sums(with_status(silver_orders, DELIVERED), "customer_id")
    per_person = _merge_sums(per_account.join(accounts, "customer_id"), "customer_unique_id")
    sums = _merge_sums(per_person.join(states, "customer_unique_id"), "state")
    table = _performance(
        sums, F.col("state"), PERFORMANCE_COLUMNS, (1, 1, 2), undated_is_late=False
    )
    return at_least(table, "total_orders", min_orders).orderBy(
        F.desc_nulls_last("avg_days_to_deliver"), "state"
    )


def worst_states(by_state: DataFrame, limit: int = 5) -> DataFrame:
    return (
        by_state.select(
            "state", "total_orders", "avg_days_to_deliver", "on_time_pct", "avg_review_score"
        )
        .orderBy(F.desc_nulls_last("avg_days_to_deliver"), "state")
        .limit(limit)
    )


def bucketed(fact: DataFrame) -> DataFrame:
    """Delivered and reviewed orders by speed class, with the share of each class."""
    score = F.col("review_score")
    rated = with_status(fact, DELIVERED).where(
        F.col("days_to_deliver").isNotNull() & score.isNotNull()
    )
    sums = _order_sums(
        rated.withColumn("delivery_bucket", delivery_bucket("days_to_deliver")), "delivery_bucket"
    )
    table = sums.select(
        "delivery_bucket",
        F.col("n").alias("total_orders"),
        rounded(ratio("score", "n_score"), 3).alias("avg_review_score"),
        rounded(ratio("days", "n_days"), 1).alias("avg_days_actual"),
        percent(ratio("happy", "n_score")).alias("csat_pct"),
        percent(ratio(F.coalesce("on_time", F.lit(0)), "n")).alias("on_time_pct"),
    )
    return share_of_total(table, "total_orders", "pct_of_orders", 1).orderBy("delivery_bucket")


# ---- smaller summaries --------------------------------------------------------------------


def segment_breakdown(people: DataFrame) -> DataFrame:
    return (
        people.groupBy("order_frequency_segment", "satisfaction_segment")
        .agg(
            F.count("*").alias("customers"),
            rounded(exact_mean("total_spend_brl"), 2).alias("avg_spend_brl"),
            rounded(exact_mean("avg_review_score"), 2).alias("avg_review"),
        )
        .orderBy(F.desc("customers"), "order_frequency_segment", "satisfaction_segment")
    )


def frequency_spend(people: DataFrame) -> DataFrame:
    return people.groupBy("order_frequency_segment").agg(
        F.count("*").alias("customers"),
        rounded(exact_mean("total_spend_brl"), 2).alias("avg_spend_brl"),
    )


def state_mean_days(people: DataFrame, limit: int = 10) -> DataFrame:
    return (
        people.groupBy("state")
        .agg(rounded(exact_mean("avg_days_to_deliver"), 2).alias("avg_delivery_days"))
        .orderBy(F.desc_nulls_last("avg_delivery_days"), "state")
        .limit(limit)
    )


def score_by_weekday(fact: DataFrame) -> DataFrame:
    return fact.groupBy("order_day_of_week").agg(
        F.count("*").alias("orders"),
        rounded(F.avg("review_score"), 3).alias("avg_review_score"),
    ).orderBy("order_day_of_week")


def cohort_spend(people: DataFrame) -> DataFrame:
    month = F.date_trunc("month", "first_order_at").cast("timestamp_ntz")
    return people.groupBy(month.alias("cohort_month")).agg(
        F.count("*").alias("customers"),
        rounded(exact_mean("total_spend_brl"), 2).alias("avg_lifetime_spend"),
    ).orderBy("cohort_month")


def late_versus_on_time(fact: DataFrame, late_days: int = 3) -> DataFrame:
    """Satisfied share of clearly late and of punctual orders."""
    delta, score = F.col("delivery_delta_days"), F.col("review_score")
    group = F.when(delta >= late_days, "late").when(F.col("delivered_on_time"), "on_time")
    return (
        with_status(fact, DELIVERED).withColumn("punctuality", group)
        .where(F.col("punctuality").isNotNull())
        .groupBy("punctuality")
        .agg(
            F.count("*").alias("orders"),
            percent(ratio(F.count_if(score >= 4), F.count(score))).alias("csat_pct"),
        )
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "order_status"
    )


def delivery_sanity(silver_orders: DataFrame) -> DataFrame:
    on_time = F.sum(F.col("delivered_on_time").cast("int"))
    return with_status(silver_orders, DELIVERED).agg(
        rounded(F.avg("days_to_deliver"), 1).alias("avg_days"),
        percent(ratio(on_time, F.count("*"))).alias("on_time_pct"),
        rounded(F.avg("review_score"), 2).alias("avg_review"),
    )


def class_balance(features: DataFrame, label: str) -> DataFrame:
    counted = features.groupBy(label).agg(F.count("*").alias("n"))
    return share_of_total(counted, "n", "pct", 2).orderBy(label)
