"""Calendar arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_column


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(as_column(end), as_column(start)).cast("bigint")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours with their fraction."""
    seconds = F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))
    return seconds / F.lit(3600.0)


def month_start(c: Column | str) -> Column:
    return F.date_trunc("month", as_column(c)).cast("timestamp_ntz")


def week_start(c: Column | str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", as_column(c)).cast("timestamp_ntz")


def weekday(c: Column | str) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return (F.dayofweek(as_column(c)) - 1).cast("bigint")


def days_earlier(c: Column | str, days: int) -> Column:
    return as_column(c) - F.make_dt_interval(F.lit(days))


def month_label(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def date_of(c: Column | str) -> Column:
    return F.to_date(as_column(c))
