"""Small text helpers used by the access log and the input checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import as_column

# Parameters never logged, their replacement, and the preview length.
SENSITIVE_PARAMETERS = ("customer_id", "email", "name", "phone", "address")
REDACTED = "<redacted>"
PREVIEW_CHARS = 200


def has_text(c: Column | str) -> Column:
    """True when there is a non-empty text; never NULL."""
    c = as_column(c)
    return c.isNotNull() & (c != "")


def preview(c: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    """Leading characters on one line."""
    head = F.substring(as_column(c), 1, chars)
    return F.regexp_replace(F.regexp_replace(head, "\n", " "), r"^\s+|\s+$", "")


def redacted(params: Column | str, keys: tuple[str, ...] = SENSITIVE_PARAMETERS) -> Column:
    """Same map, with the values of sensitive keys replaced."""
    return F.transform_values(
        as_column(params), lambda k, v: F.when(k.isin(*keys), F.lit(REDACTED)).otherwise(v)
    )


def iso_date(c: Column | str) -> Column:
    """Date of a strict ``YYYY-MM-DD`` text, otherwise NULL (a plain cast is laxer)."""
    c = as_column(c)
    return F.when(c.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.try_to_date(c, "yyyy-MM-dd"))
