"""Ranks over a whole table, or over groups of any size, without one task holding the group.

A window without PARTITION BY, or with a group that holds a large part of the table, sorts
that group in a single task. Here the rows are range-partitioned instead, so every task gets
an equal slice of the order; what is missing inside a slice is only how much came before it,
and that is one number per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import as_column, ratio, rounded
from ..session import handed_over

SLICE, AT, BEFORE = "_slice", "_at", "_before"
#: monotonically_increasing_id() keeps the partition above, the row number below this bit.
ROW_BITS = 33


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys meet, as they do in a window partition.

    ``left`` may have very many rows of one key. AQE splits such a partition when both inputs
    of the join come straight from a shuffle, so an aggregated ``right`` is handed_over by the caller.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, same).drop(*[f"_r_{k}" for k in keys])


def _starts(sizes: DataFrame) -> DataFrame:
    """Exclusive running sum over slices: one row per partition, so never large."""
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    return sizes.select(SLICE, before.alias(BEFORE))


def with_position(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """1-based place of every row in a total order (``order`` must end in a unique key).

    The slices are handed_over to reliable storage before they are counted: counts and rows must
    come from the same split even if an executor is lost in between.
    """
    order = [as_column(c) for c in order]
    sliced = handed_over(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(AT, F.monotonically_increasing_id())
    )
    sliced = sliced.withColumn(SLICE, F.shiftright(AT, ROW_BITS))
    sizes = sliced.groupBy(SLICE).agg(F.count("*").alias("_size"))
    local = F.col(AT).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        sliced.join(F.broadcast(_starts(sizes)), SLICE)
        .withColumn(out, F.col(BEFORE) + local + 1)
        .drop(SLICE, AT, BEFORE)
    )


def with_running_totals(
    df: DataFrame, order: Sequence[Column | str], weights: Mapping[str, str]
) -> DataFrame:
    """For each ``weight: out``: sum of the weight over this row and all ordered before it."""
    order = [as_column(c) for c in order]
    sliced = handed_over(
        df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id()), "slices"
    )
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice, so never large
    starts = sliced.groupBy(SLICE).agg(*[F.sum(w).alias(f"_all_{w}") for w in weights]).select(
        SLICE, *[F.coalesce(F.sum(f"_all_{w}").over(earlier), F.lit(0)).alias(f"_before_{w}")
                 for w in weights]
    )
    inside = Window.partitionBy(SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = {f"_here_{w}": F.sum(w).over(inside) for w in weights}
    return (
        sliced.withColumns(here).join(F.broadcast(starts), SLICE)
        .withColumns({out: F.col(f"_before_{w}") + F.col(f"_here_{w}") for w, out in weights.items()})
        .drop(SLICE, *here, *[f"_before_{w}" for w in weights])
    )


def with_running_total(
    df: DataFrame, order: Sequence[Column | str], weight: str, out: str
) -> DataFrame:
    """Sum of ``weight`` over this row and all rows ordered before it."""
    return with_running_totals(df, order, {weight: out})


def ntile(df: DataFrame, value: str, key: str, tiles: int, out: str) -> DataFrame:
    """Equal-sized tiles over the whole table; the first ones take the remainder."""
    placed = with_position(df, [F.col(value).asc_nulls_last(), key], "_place")
    placed = placed.withColumn("_total", placed.agg(F.count("*")).scalar())
    place = F.col("_place") - 1
    size = F.expr(f"_total div {tiles}")
    larger = F.col("_total") % tiles
    in_larger = larger * (size + 1)
    tile = F.when(place < in_larger, F.floor(F.try_divide(place, size + 1)) + 1).otherwise(
        larger + F.floor(F.try_divide(place - in_larger, size)) + 1
    )
    return placed.withColumn(out, tile.cast("bigint")).drop("_place", "_total")


def _places_of_values(
    df: DataFrame, group: Sequence[str], value: str, descending: bool
) -> DataFrame:
    """For every distinct value of a group: how many rows of the group come before it.

    Works on value counts, so rows sharing one value are combined before the shuffle.
    """
    counts = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    by = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    run = with_running_total(counts, [*group, by], "_n", "_upto").withColumn(
        "_place", F.col("_upto") - F.col("_n")
    )
    if not group:
        return run.select(value, "_place", "_n")
    first = handed_over(run.groupBy(*group).agg(F.min("_place").alias("_first")))
    return _meet(run, first, group).select(
        *group, value, (F.col("_place") - F.col("_first")).alias("_place")
    )


def percent_rank(df: DataFrame, value: str, out: str, digits: int = 4) -> DataFrame:
    """(rank - 1) / (rows - 1) over the whole table, rounded; 0 for a single row."""
    places = _places_of_values(df, [], value, descending=False)
    places = places.withColumn("_total", places.agg(F.sum("_n")).scalar())
    share = F.coalesce(ratio("_place", F.col("_total") - 1), F.lit(0.0))
    return _meet(df, places.select(value, rounded(share, digits).alias(out)), [value])


def rank_within(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """RANK inside each group, largest value first; equal values share a rank."""
    places = _places_of_values(df, group, value, descending=True)
    return _meet(df, places.withColumn(out, F.col("_place") + 1).drop("_place"), [*group, value])


def number_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], out: str
) -> DataFrame:
    """ROW_NUMBER inside each group, for groups that may be larger than one task can hold."""
    placed = with_position(df, [*group, *order], "_place")
    first = handed_over(placed.groupBy(*group).agg(F.min("_place").alias("_first")))
    return (
        _meet(placed, first, group)
        .withColumn(out, F.col("_place") - F.col("_first") + 1)
        .drop("_place", "_first")
    )


def quantiles(
    df: DataFrame, group: Sequence[str], value: str, shares: Mapping[str, float],
    count: str | None = None,
) -> DataFrame:
    """Exact quantiles of every group, interpolated between neighbours: one row per group.

    ``shares`` names a column for each share in [0, 1]; ``count`` names one for the rows with a
    value. Rows of one value are counted first; the counts of all groups are ordered together
    and cut into slices, so a group may be as large as the table. NULL keys form a group, NULL
    values are left out. Without group columns there is always one row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(
        F.count("*").alias("_n")
    )
    by = [*[F.col(g).asc_nulls_first() for g in group], F.col(value)]
    run = with_running_total(counts, by, "_n", "_upto")
    bounds = handed_over(run.groupBy(*group).agg(
        F.min(F.col("_upto") - F.col("_n")).alias("_first"), F.max("_upto").alias("_last")
    ), "bounds")
    size = F.col("_last") - F.col("_first")
    met = _meet(run, bounds, group) if group else run.join(F.broadcast(bounds))
    met = met.withColumns({"_size": size, "_to": F.col("_upto") - F.col("_first")})
    holds = lambda place: (place < F.col("_to")) & (place >= F.col("_to") - F.col("_n"))
    at = {name: F.lit(float(share)) * (F.col("_size") - 1) for name, share in shares.items()}
    found = met.groupBy(*group).agg(
        F.first("_size").alias("_size"),
        *[F.max(F.when(holds(edge(at[name])), F.col(value))).alias(f"_{side}_{name}")
          for name in shares for side, edge in (("low", F.floor), ("high", F.ceil))],
    )
    between = lambda name: F.col(f"_low_{name}") + (
        F.col(f"_high_{name}") - F.col(f"_low_{name}")
    ) * (at[name] - F.floor(at[name]))
    counted = [F.col("_size").alias(count)] if count else []
    return found.select(*group, *counted, *[between(name).alias(name) for name in shares])


def thresholds(
    df: DataFrame, group: Sequence[str], order: Sequence[str], place: Column
) -> DataFrame:
    """For each group the values of ``order`` on its row number ``place``, counted from 1.

    ``place`` may use ``_size``, the rows of the group; a place below 1 gives no row, one beyond
    the last gives none either. ``order`` must end in a unique key. Only these columns move, and
    no group has to fit one task: places come from ordered slices.
    """
    placed = with_position(df.select(*group, *order), [*group, *order], "_place")
    sizes = handed_over(placed.groupBy(*group).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_size")
    ), "sizes")
    return (
        _meet(placed, sizes, group)
        .where(F.col("_place") - F.col("_first") + 1 == place)
        .select(*group, *order)
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of many numeric columns at once: one row (column_name, median).

    All columns are unpivoted and each is a group of its own.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return quantiles(long, ["column_name"], "value", {"median": 0.5})
