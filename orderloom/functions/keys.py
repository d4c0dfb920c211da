"""Keys and pick-one aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_column

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_IN_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the fields joined by a dash."""
    fields = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_IN_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *fields))


def _rank_key(by: Column | str, ties: tuple[Column | str, ...]) -> Column:
    by = as_column(by)
    return F.when(by.isNotNull(), F.struct(by, *[as_column(t) for t in ties]))


def value_at_max(value: Column | str, by: Column | str, *ties: Column | str) -> Column:
    """Value on the row with the largest ``by``; rows without ``by`` never win.

    ``ties`` decide between equal rows, so the answer does not depend on row order.
    """
    return F.max_by(as_column(value), _rank_key(by, ties))


def value_at_min(value: Column | str, by: Column | str, *ties: Column | str) -> Column:
    return F.min_by(as_column(value), _rank_key(by, ties))


def any_true(condition: Column | str) -> Column:
    return F.bool_or(as_column(condition))
