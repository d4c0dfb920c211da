"""Do fast deliveries score better? Two-group comparison from one pass over the orders."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import as_column, percent, ratio, rounded
from ..functions.segments import effect_label
from .kpis import DELIVERED, with_status

# Days that count as fast, significance level, effect worth acting on.
FAST_DAYS = 7
ALPHA = 0.05
WORTHWHILE_EFFECT = 0.2


def rated_deliveries(fact: DataFrame, fast_days: int = FAST_DAYS) -> DataFrame:
    days = F.col("days_to_deliver")
    return (
        with_status(fact, DELIVERED)
        .where(F.col("review_score").isNotNull() & (days >= 0))
        .select("order_id", "review_score",
                F.when(days <= fast_days, "fast").otherwise("slow").alias("speed"))
    )


def _moments(condition: Column, prefix: str) -> list[Column]:
    score = F.when(condition, F.col("review_score").cast("bigint"))
    return [
        F.count(score).alias(f"{prefix}_n"),
        F.sum(score).alias(f"{prefix}_sum"),
        F.sum(score * score).alias(f"{prefix}_squares"),
    ]


def _variance(prefix: str) -> Column:
    """Sample variance from integer sums, which carry no rounding error."""
    n, total = F.col(f"{prefix}_n"), F.col(f"{prefix}_sum").cast("double")
    spread = F.col(f"{prefix}_squares").cast("double") - ratio(total * total, n)
    return ratio(spread, n - 1)


def group_moments(rated: DataFrame) -> DataFrame:
    """One row: size, mean and variance of both groups, and the difference of the means."""
    speed = F.col("speed")
    sums = rated.agg(*_moments(speed == "fast", "fast"), *_moments(speed == "slow", "slow"))
    return sums.select(
        "fast_n", "slow_n",
        ratio("fast_sum", "fast_n").alias("fast_mean"),
        ratio("slow_sum", "slow_n").alias("slow_mean"),
        _variance("fast").alias("fast_variance"),
        _variance("slow").alias("slow_variance"),
    ).withColumn("difference", F.col("fast_mean") - F.col("slow_mean"))


def with_welch(moments: DataFrame) -> DataFrame:
    """t statistic and degrees of freedom without assuming equal variances."""
    a, b = ratio("fast_variance", "fast_n"), ratio("slow_variance", "slow_n")
    df = ratio(
        (a + b) * (a + b),
        ratio(a * a, F.col("fast_n") - 1) + ratio(b * b, F.col("slow_n") - 1),
    )
    return moments.withColumn("t_statistic", ratio("difference", F.sqrt(a + b))).withColumn(
        "degrees_of_freedom", df
    )


def with_effect(moments: DataFrame) -> DataFrame:
    """Cohen's d over the pooled deviation, with its conventional label."""
    fast, slow = F.col("fast_n") - 1, F.col("slow_n") - 1
    pooled = ratio(
        fast * F.col("fast_variance") + slow * F.col("slow_variance"), fast + slow
    )
    return moments.withColumn("cohens_d", ratio("difference", F.sqrt(pooled))).withColumn(
        "effect", effect_label("cohens_d")
    )


#: Steps of the integral below, and their width.
STEPS, WIDTH = 4000, 0.01


def _tail(start: Column, degrees: Column) -> Column:
    """Area under the density of t, but for its constant, from sinh(start) on, by Simpson's rule.

    With x = sinh(s) the density falls at least like exp(-s) for any degrees of freedom, so 40
    units of s hold all of it.
    """
    def height(i: Column) -> Column:
        s = start + i * WIDTH
        fall = F.log(1.0 + F.sinh(s) * F.sinh(s) / degrees) * (degrees + 1) / -2.0
        weight = F.when((i == 0) | (i == STEPS), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return weight * F.exp(fall) * F.cosh(s)

    places = F.sequence(F.lit(0), F.lit(STEPS))
    return F.aggregate(places, F.lit(0.0), lambda sum_, i: sum_ + height(i))


def two_sided_p(t: Column | str, degrees: Column | str) -> Column:
    """Probability of a t statistic at least this far from zero; NULL without degrees of freedom.

    The tail over the half line, so the constant of the density is not needed.
    """
    t, degrees = as_column(t), as_column(degrees)
    from_t = F.log(F.abs(t) + F.sqrt(t * t + 1.0))  # asinh
    return F.when(degrees > 0, _tail(from_t, degrees) / _tail(F.lit(0.0), degrees))


def with_p_value(tested: DataFrame) -> DataFrame:
    """Adds the p-value to the single result row."""
    return tested.withColumn("p_value", two_sided_p("t_statistic", "degrees_of_freedom"))


def conclusion(
    rated: DataFrame, alpha: float = ALPHA, worthwhile: float = WORTHWHILE_EFFECT
) -> DataFrame:
    """Whole test in one row, with its two verdicts."""
    tested = with_p_value(with_effect(with_welch(group_moments(rated))))
    return tested.withColumns({
        "significant": F.col("p_value") < alpha,
        "worth_investing": F.abs("cohens_d") >= worthwhile,
    })


def review_histogram(rated: DataFrame) -> DataFrame:
    """Counts and shares of every score within its speed group."""
    counts = rated.groupBy("speed", "review_score").agg(F.count("*").alias("reviews"))
    totals = counts.groupBy("speed").agg(F.sum("reviews").alias("_total"))
    return counts.join(totals, "speed").select(
        "speed", "review_score", "reviews", percent(ratio("reviews", "_total")).alias("pct")
    )


def rounded_result(row: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles of a result row cut to comparable digits."""
    return row.select([
        rounded(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in row.dtypes
    ])
