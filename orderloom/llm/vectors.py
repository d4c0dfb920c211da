"""Vectors as whole numbers, which every sum of them keeps exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.expr(
        f"coalesce(forall({vector}, x -> x IS NOT NULL AND NOT isnan(x)"
        f" AND abs(double(x)) < double('infinity')), false)"
    )


def whole(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.expr(f"transform({vector}, x -> floor({scale}D * double(x)))")


def width_of(rows: DataFrame, vector: str) -> int:
    """Number of components of the longest vector; shorter ones count as filled up with 0."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def check_room(largest: int, terms: int) -> None:
    """Sums of squares must fit 64 bits, or they would not be exact."""
    if largest * largest * max(terms, 1) >= 2**62:
        raise ValueError(f"components up to {largest} are too large for exact 64-bit sums")
