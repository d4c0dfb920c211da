"""Business labels: every rule is one CASE expression over its input column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .numeric import as_column

# Accepted categories, bounds and label texts.
ORDER_STATUSES = (
    "approved", "canceled", "created", "delivered",
    "invoiced", "processing", "shipped", "unavailable",
)
RETAINED_STATUSES = ("delivered", "shipped", "processing", "approved")
REVIEW_SCORES = (1, 2, 3, 4, 5)
SATISFACTION_FLOORS = ((4, "satisfied"), (3, "neutral"))
RISK_TIERS = ("critical", "high", "medium", "low")
RISK_FLOORS = ((0.85, "critical"), (0.65, "high"), (0.40, "medium"))
DELIVERY_BUCKETS = (
    (3, "1. ≤ 3 days (fast)"),
    (7, "2. 4–7 days (standard)"),
    (14, "3. 8–14 days (slow)"),
    (21, "4. 15–21 days (very slow)"),
)
SLOWEST_BUCKET = "5. 22+ days (extreme)"
SPEND_TIERS = ((10, "Top 10% spender"), (8, "High spender"), (5, "Mid spender"))
RETENTION_FLOORS = ((2.0, "Above average retention"), (1.0, "Average retention"))
LOYALTY_WEIGHTS = {"loyal": 0.15, "repeat": 0.10}
WIN_BACK = "Win-back: satisfied but inactive — offer loyalty discount"
RECOVER = "Service recovery: address complaint before re-engagement"
NURTURE = "Nurture: send re-engagement email with personalised offer"
MONITOR = "Monitor: include in loyalty program communications"
EFFECT_SIZES = ((0.20, "Negligible"), (0.50, "Small"), (0.80, "Medium"))


def _first_at_least(c: Column, steps: Sequence[tuple], default: str) -> Column:
    rule = F
    for floor, label in steps:
        rule = rule.when(c >= floor, label)
    return rule.otherwise(default)


def _first_up_to(c: Column, steps: Sequence[tuple], default: str) -> Column:
    rule = F
    for ceiling, label in steps:
        rule = rule.when(c <= ceiling, label)
    return rule.otherwise(default)


def frequency_segment(orders: Column | str, zero_order_label: str = "loyal") -> Column:
    """One order, two to four, more. People without orders fall in the last class by default."""
    n = as_column(orders)
    return (
        F.when(n == 1, "one_time")
        .when(n.between(2, 4), "repeat")
        .when(n > 4, "loyal")
        .otherwise(zero_order_label)
    )


def satisfaction_segment(score: Column | str) -> Column:
    """People who never reviewed count as dissatisfied."""
    return _first_at_least(as_column(score), SATISFACTION_FLOORS, "dissatisfied")


def risk_tier(probability: Column | str) -> Column:
    return _first_at_least(as_column(probability), RISK_FLOORS, "low")


def risk_tier_rank(tier: Column | str) -> Column:
    """Position in the fixed presentation order of the tiers."""
    return F.array_position(F.array(*[F.lit(t) for t in RISK_TIERS]), as_column(tier))


def delivery_bucket(days: Column | str) -> Column:
    return _first_up_to(as_column(days), DELIVERY_BUCKETS, SLOWEST_BUCKET)


def spend_tier(decile: Column | str) -> Column:
    return _first_at_least(as_column(decile), SPEND_TIERS, "Low spender")


def retention_label(percentage: Column | str) -> Column:
    return _first_at_least(as_column(percentage), RETENTION_FLOORS, "Below average retention")


def loyalty_weight(segment: Column | str) -> Column:
    segment, rule = as_column(segment), F
    for name, weight in LOYALTY_WEIGHTS.items():
        rule = rule.when(segment == name, F.lit(weight))
    return rule.otherwise(F.lit(0.0))


def recommended_action(tier: Column | str, satisfaction: Column | str) -> Column:
    tier, satisfaction = as_column(tier), as_column(satisfaction)
    urgent = tier.isin("critical", "high")
    return (
        F.when(urgent & (satisfaction == "satisfied"), WIN_BACK)
        .when(urgent & (satisfaction == "dissatisfied"), RECOVER)
        .when(tier == "medium", NURTURE)
        .otherwise(MONITOR)
    )


def seller_flag(rank: Column | str, days_over_median: Column | str) -> Column:
    over = as_column(days_over_median)
    return (
        F.when((as_column(rank) == 1) & (over >= 3), "Underperformer: action needed")
        .when(over >= 1.5, "Watch: above category average")
        .otherwise("On track")
    )


def effect_label(effect: Column | str) -> Column:
    """Conventional reading of a standardised mean difference."""
    size, rule = F.abs(as_column(effect)), F
    for bound, label in EFFECT_SIZES:
        rule = rule.when(size < bound, label)
    return rule.otherwise("Large")
