"""Rounding, ratios and sums that give the same digits in whatever order rows arrive."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

#: Wide enough for sums of money over very large tables, eight decimals kept.
EXACT = "decimal(28,8)"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: Column | str) -> Column:
    """Decimal copy of a double, so that adding it up does not depend on row order."""
    return as_column(c).cast(EXACT)


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding decided on decimal digits rather than on binary fractions."""
    return F.round(exact(c), digits).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; NULL when the denominator is zero."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


def exact_sum(c: Column | str) -> Column:
    return F.sum(exact(c)).cast("double")


def exact_mean(c: Column | str) -> Column:
    return ratio(F.sum(exact(c)), F.count(as_column(c)))


# Money is added up as two integers, whole units and millionths. Unlike decimals these stay in
# the fast path of the hash aggregate, and unlike doubles they add up the same in any order.

MILLION = 1_000_000


def money_whole(c: Column | str) -> Column:
    return F.floor(as_column(c))


def money_part(c: Column | str) -> Column:
    c = as_column(c)
    return F.rint((c - F.floor(c)) * float(MILLION)).cast("bigint")


def money_total(whole: Column | str, part: Column | str) -> Column:
    """Decimal amount of summed whole units and summed millionths."""
    whole, part = as_column(whole), as_column(part)
    carried = whole + F.floor(part / F.lit(MILLION).cast("decimal(7,0)"))
    rest = (part % MILLION).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    return (carried.cast("decimal(20,0)") + rest).cast(EXACT)


def money_sum(c: Column | str) -> Column:
    """Exact sum of an amount, up to 9e12 rows per group."""
    return money_total(F.sum(money_whole(c)), F.sum(money_part(c)))


def money_mean(c: Column | str) -> Column:
    return ratio(money_sum(c), F.count(as_column(c)))


def percent(c: Column | str, digits: int = 1) -> Column:
    return rounded(as_column(c) * 100.0, digits)


def flag(condition: Column) -> Column:
    """Truth value as 0/1 integer."""
    return condition.cast("int")
