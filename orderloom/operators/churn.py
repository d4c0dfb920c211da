"""Churn features, labels and the scored customer mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_of, days_between, days_earlier
from ..functions.keys import any_true, value_at_max
from ..functions.numeric import (
    flag, money_mean, money_part, money_total, money_whole, ratio, rounded,
)
from ..functions.segments import risk_tier, risk_tier_rank
from .ranking import quantiles

# Inputs of the model, and those from which its label can be read off.
NUMERIC_FEATURES = (
    "days_since_last_order", "days_since_first_order", "customer_lifespan_days",
    "recency_to_lifespan_ratio", "total_orders", "delivered_orders", "canceled_orders",
    "cancel_rate", "total_spend_brl", "avg_order_value_brl", "avg_freight_brl",
    "freight_to_value_ratio", "avg_review_score", "review_count", "has_low_review",
    "pct_reviews_with_comment", "avg_days_to_deliver", "on_time_delivery_rate",
    "had_late_delivery", "used_voucher_ever", "used_credit_card_ever", "avg_item_count",
    "avg_distinct_products", "avg_distinct_sellers",
)
CATEGORICAL_FEATURES = (
    "state", "order_frequency_segment", "satisfaction_segment", "primary_payment_type",
)
#: Counts of a basket whose means are signals.
BASKET = ("item_count", "distinct_products", "distinct_sellers")
LEAKY_FEATURES = ("days_since_last_order", "recency_to_lifespan_ratio")


def _or(c: Column | str, default) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def order_signals(fact: DataFrame) -> DataFrame:
    """Per person: basket means, payment habits and review extremes."""
    score = F.col("review_score")
    return fact.where("customer_unique_id IS NOT NULL").groupBy("customer_unique_id").agg(
        F.avg("item_count").alias("avg_item_count"),
        F.avg("distinct_products").alias("avg_distinct_products"),
        F.avg("distinct_sellers").alias("avg_distinct_sellers"),
        money_mean("freight_total_brl").alias("avg_freight_brl"),
        any_true("used_voucher").alias("used_voucher_ever"),
        any_true("used_credit_card").alias("used_credit_card_ever"),
        value_at_max("primary_payment_type", "total_payment_value", "order_id")
        .alias("primary_payment_type"),
        _or(F.min(score), 5).alias("min_review_score"),
        ratio(F.count_if("has_review_comment"), F.count(score))
        .alias("pct_reviews_with_comment"),
    )


def signal_sums() -> dict[str, tuple[Column, Column]]:
    """What ``order_signals`` needs of an account, and how accounts are merged to a person."""
    value = F.col("total_payment_value")
    dearest = F.when(
        value.isNotNull(),
        F.struct("total_payment_value", "order_id", "primary_payment_type"),
    )
    added = lambda column, name: (column, F.sum(name))
    sums = {"_min_score": (F.min("review_score"), F.min("_min_score")),
            "_dearest": (F.max(dearest), F.max("_dearest")),
            "_voucher": (any_true("used_voucher"), any_true("_voucher")),
            "_credit": (any_true("used_credit_card"), any_true("_credit")),
            "_commented": added(F.count_if("has_review_comment"), "_commented"),
            "_freight_whole": added(F.sum(money_whole("freight_total_brl")), "_freight_whole"),
            "_freight_part": added(F.sum(money_part("freight_total_brl")), "_freight_part"),
            "_n_freight": added(F.count("freight_total_brl"), "_n_freight")}
    for name in BASKET:
        sums[f"_{name}"] = added(F.sum(name), f"_{name}")
        sums[f"_n_{name}"] = added(F.count(name), f"_n_{name}")
    return sums


def with_signals(people: DataFrame) -> DataFrame:
    """The columns of ``order_signals`` from merged ``signal_sums``."""
    freight = money_total("_freight_whole", "_freight_part")
    return people.withColumns({
        **{f"avg_{name}": ratio(f"_{name}", f"_n_{name}") for name in BASKET},
        "avg_freight_brl": ratio(freight, "_n_freight"),
        "used_voucher_ever": F.col("_voucher"),
        "used_credit_card_ever": F.col("_credit"),
        "primary_payment_type": F.col("_dearest.primary_payment_type"),
        "min_review_score": _or("_min_score", 5),
        "pct_reviews_with_comment": ratio("_commented", "review_count"),
    }).drop(*signal_sums())


def reference_date(fact: DataFrame) -> Column:
    """Newest purchase as a scalar subquery: one value, nothing brought to the driver."""
    return fact.agg(F.max("purchased_at")).scalar()


def _inactive(last: str, cutoff: str, inclusive: bool) -> Column:
    return F.col(last) <= F.col(cutoff) if inclusive else F.col(last) < F.col(cutoff)


def eligible(
    people: DataFrame, purchases: DataFrame, horizon_days: int = 90, inclusive: bool = True
) -> DataFrame:
    """Everyone whose first order lies at least ``horizon_days`` back, with the label.

    Label 1: no order within the horizon before the newest of ``purchases``. Needs the dates of
    the first and the last order only.
    """
    return (
        people.withColumn("reference_date", reference_date(purchases))
        .withColumn("churn_cutoff_date", days_earlier("reference_date", horizon_days))
        .where(F.col("first_order_at") <= F.col("churn_cutoff_date"))
        .withColumn(
            "is_churned", flag(_inactive("last_order_at", "churn_cutoff_date", inclusive))
        )
    )


def features(
    fact: DataFrame, people: DataFrame, horizon_days: int = 90, inclusive: bool = True
) -> DataFrame:
    """Feature row of everyone who is ``eligible``."""
    known = eligible(people, fact, horizon_days, inclusive)
    return feature_columns(known.join(order_signals(fact), "customer_unique_id", "left"))


def feature_columns(known: DataFrame) -> DataFrame:
    """The feature row from history, signals, dates and label."""
    return (
        known.withColumns({
            "days_since_last_order": days_between("last_order_at", "reference_date"),
            "days_since_first_order": days_between("first_order_at", "reference_date"),
        })
        .select(
            "customer_unique_id", "customer_sk", "state",
            "days_since_last_order", "days_since_first_order", "customer_lifespan_days",
            _or(ratio("days_since_last_order", "days_since_first_order"), 1.0)
            .alias("recency_to_lifespan_ratio"),
            "total_orders", "delivered_orders", "canceled_orders",
            _or(ratio("canceled_orders", "total_orders"), 0.0).alias("cancel_rate"),
            "order_frequency_segment",
            "total_spend_brl", "avg_order_value_brl",
            _or("avg_freight_brl", 0.0).alias("avg_freight_brl"),
            _or(ratio("avg_freight_brl", "avg_order_value_brl"), 0.0)
            .alias("freight_to_value_ratio"),
            _or("avg_review_score", 3.0).alias("avg_review_score"),
            "review_count",
            flag(_or("min_review_score", 5) <= 2).alias("has_low_review"),
            _or("pct_reviews_with_comment", 0.0).alias("pct_reviews_with_comment"),
            "satisfaction_segment",
            _or("avg_days_to_deliver", 15.0).alias("avg_days_to_deliver"),
            _or(ratio("on_time_deliveries", "delivered_orders"), 0.0)
            .alias("on_time_delivery_rate"),
            flag(_or("on_time_deliveries", 0) < _or("delivered_orders", 1))
            .alias("had_late_delivery"),
            flag(_or("used_voucher_ever", False)).alias("used_voucher_ever"),
            flag(_or("used_credit_card_ever", False)).alias("used_credit_card_ever"),
            _or("primary_payment_type", "unknown").alias("primary_payment_type"),
            _or("avg_item_count", 1.0).alias("avg_item_count"),
            _or("avg_distinct_products", 1.0).alias("avg_distinct_products"),
            _or("avg_distinct_sellers", 1.0).alias("avg_distinct_sellers"),
            "reference_date", "churn_cutoff_date", "is_churned",
        )
    )


def silver_features(
    silver_customers: DataFrame, silver_orders: DataFrame, horizon_days: int = 180
) -> DataFrame:
    """Twin over the silver tables: everyone is eligible, label by days strictly beyond."""
    newest = silver_orders.agg(F.max("order_purchase_timestamp")).scalar()
    frequency, mood = F.col("order_frequency_segment"), F.col("satisfaction_segment")
    return (
        silver_customers.withColumn("_newest", newest)
        .withColumns({
            "days_since_last_order": days_between("last_order_at", "_newest"),
            "days_since_first_order": days_between("first_order_at", "_newest"),
        })
        .select(
            "customer_unique_id", "days_since_last_order", "days_since_first_order",
            "customer_lifespan_days", "total_orders", "total_spend_brl", "avg_order_value_brl",
            "avg_review_score", "avg_days_to_deliver", "on_time_deliveries", "review_count",
            *[flag(frequency == s).alias(f"is_{s}") for s in ("one_time", "repeat", "loyal")],
            *[flag(mood == s).alias(f"is_{s}") for s in ("dissatisfied", "satisfied")],
            flag(F.col("days_since_last_order") > horizon_days).alias("churned"),
        )
    )


CONTEXT_COLUMNS = (
    "state", "order_frequency_segment", "satisfaction_segment", "total_orders",
    "total_spend_brl", "avg_order_value_brl", "avg_review_score", "avg_days_to_deliver",
    "first_order_at", "last_order_at", "customer_lifespan_days",
)


def tiered(predictions: DataFrame) -> DataFrame:
    """Typed scores with their risk tier."""
    return predictions.select(
        "customer_unique_id",
        F.col("churn_probability").try_cast("double").alias("churn_probability"),
        F.col("predicted_label").try_cast("int").alias("predicted_label"),
        "model_name",
        F.col("prediction_generated_at").try_cast("timestamp_ntz")
        .alias("prediction_generated_at"),
        risk_tier(F.col("churn_probability").try_cast("double")).alias("churn_risk_tier"),
    )


def scored_mart(predictions: DataFrame, people: DataFrame) -> DataFrame:
    """Scores with tier and customer context; scores of unknown people stay."""
    context = people.select("customer_unique_id", *CONTEXT_COLUMNS)
    return tiered(predictions).join(context, "customer_unique_id", "left")


def score_listing(mart: DataFrame) -> DataFrame:
    """Presentation of the mart, highest risk first."""
    return mart.select(
        "customer_unique_id",
        rounded("churn_probability", 3).alias("churn_prob"),
        "churn_risk_tier", "state",
        F.col("order_frequency_segment").alias("freq_segment"),
        F.col("satisfaction_segment").alias("sat_segment"),
        "total_orders",
        rounded("total_spend_brl", 2).alias("spend_brl"),
        rounded("avg_review_score", 2).alias("avg_review"),
        date_of("last_order_at").alias("last_order"),
    ).orderBy(F.desc_nulls_last("churn_prob"), "customer_unique_id")


def tier_counts(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("churn_risk_tier").agg(F.count("*").alias("customers"))
        .orderBy(risk_tier_rank("churn_risk_tier"))
    )


def score_histogram(listing: DataFrame, bins: int = 40) -> DataFrame:
    """Counts in equal bins over [0, 1]; probability 1 belongs to the last bin."""
    place = F.least(F.width_bucket("churn_prob", F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return (
        listing.where("churn_prob IS NOT NULL")
        .groupBy(place.cast("bigint").alias("bin")).agg(F.count("*").alias("customers"))
        .orderBy("bin")
    )


def score_quartiles(
    rows: DataFrame, segment: str, value: str = "churn_prob", count: str = "customers"
) -> DataFrame:
    """Five-number summary of a value per segment, exact at any precision and segment size."""
    marks = {"minimum": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75,
             "maximum": 1.0}
    summary = quantiles(rows, [segment], value, marks, count)
    return summary.select(segment, count, *[rounded(m, 6).alias(m) for m in marks])


def at_risk(
    listing: DataFrame, min_spend: float = 200, min_probability: float = 0.5, limit: int = 50
) -> DataFrame:
    return (
        listing.where((F.col("spend_brl") > min_spend) & (F.col("churn_prob") > min_probability))
        .orderBy(F.desc("churn_prob"), "customer_unique_id")
        .limit(limit)
        .select(
            "customer_unique_id", "churn_risk_tier", "churn_prob", "spend_brl", "total_orders",
            "avg_review", "state", "last_order",
        )
    )


