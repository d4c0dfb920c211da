"""Shards from a weighted tree of regions, racks and shards.

A document descends the tree. At each level every child draws a number from the key and the
child's name, scaled by the child's weight, and the best draw wins, so a child gets documents
in proportion to its weight. A child whose weight grows can only win draws it lost before:
what moves, moves into the subtree whose weight changed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import handed_over, release
from .shared import content

#: Hex digits of a draw's hash: 13 digits are 52 bits, exact in a double.
DIGITS = 13
ROW_BITS = 33


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, racks: int = 2, per_rack: int = 2) -> tuple[Leaf, ...]:
    """Shards of equal weight, ``per_rack`` to a rack and ``racks`` racks to a region."""
    per_region = racks * per_rack
    return tuple(
        Leaf(f"region{s // per_region}", f"rack{s % per_region // per_rack}", s)
        for s in range(shards)
    )


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> tuple[Leaf, ...]:
    """One more shard, in a region of its own.

    No other region, rack or shard changes its weight, so documents move into the new shard only.
    A shard added to an existing region would also shift documents inside that region.
    """
    new = max((leaf.shard for leaf in tree), default=-1) + 1
    return (*tree, Leaf(f"region-of-{new}", "rack0", new, weight))


def _draw(key: Column, node: str, weight: float) -> Column:
    """Exponential race: -ln(u) / weight, u uniform in (0, 1) by key and node; least wins."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{node}|"), key)), 1, DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    return -F.ln(u) / F.lit(float(weight))


def _winner(key: Column, prefix: str, children: dict[str, float]) -> Column:
    """Name of the child with the least draw; the first by name if draws are equal."""
    named = sorted((n, w) for n, w in children.items() if w > 0)
    if len(named) == 1:
        return F.lit(named[0][0])
    draws = F.array_sort(F.array(*[
        F.struct(_draw(key, f"{prefix}/{n}", w).alias("draw"), F.lit(n).alias("name"))
        for n, w in named
    ]))
    return draws[0]["name"]


def placed(key: Column, tree: Sequence[Leaf]) -> Column:
    """Shard of a key. The key is read as text; null is a key like any other.

    Weights of 0 take nothing; a tree without any weight is an error.
    """
    key = F.coalesce(key.cast("string"), F.lit("null"))
    regions: dict = defaultdict(lambda: defaultdict(dict))
    for leaf in tree:
        if leaf.weight > 0:
            regions[leaf.region][leaf.rack][str(leaf.shard)] = leaf.weight
    if not regions:
        raise ValueError("a tree needs a shard with a weight above 0")
    total = lambda racks: sum(sum(s.values()) for s in racks.values())

    def among(column: Column, options: dict) -> Column:
        """The expression of the option the column names."""
        chosen = None
        for name, expression in sorted(options.items()):
            test = column == name
            chosen = F.when(test, expression) if chosen is None else chosen.when(test, expression)
        return chosen

    region = _winner(key, "", {r: total(racks) for r, racks in regions.items()})
    below = {}
    for r, racks in regions.items():
        rack = _winner(key, r, {k: sum(s.values()) for k, s in racks.items()})
        below[r] = among(rack, {k: _winner(key, f"{r}/{k}", s) for k, s in racks.items()})
    return among(region, below).cast("int")


def with_slots(rows: DataFrame, group: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Place of each row in its group, from 0 and without gaps, for groups of any size.

    Rows are range-partitioned by group and order and stored, so a group may spread over many
    tasks; each adds only the number of rows its slices have before it. Rows that are equal in
    group and order take their slots in either order.
    """
    local = F.monotonically_increasing_id()
    sliced = handed_over(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("_at", local),
        "slices",
    ).withColumn("_slice", F.shiftright("_at", ROW_BITS))
    # first local place and size of each group in each slice: groups times slices at most once
    # each, since a slice holds a contiguous range
    parts = sliced.groupBy("_slice", group).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_size")
    )
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = parts.select(
        F.col("_slice").alias("_s"), F.col(group).alias("_g"), "_first",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    return (
        sliced.join(
            starts, (F.col("_slice") == F.col("_s")) & F.col(group).eqNullSafe(F.col("_g"))
        )
        .withColumn(out, F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_at", "_slice", "_s", "_g", "_first", "_before")
    )


def assign(
    docs: DataFrame, tree: Sequence[Leaf], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    The size is the text's length in UTF-8 bytes plus 1, a null text having none; its CRC-32 is
    that of the empty text. Rows that repeat a key share their shard, each with a slot of its own.
    ``grown_shard`` is where the row would be with one more shard.
    """
    small = docs.select(
        F.col(key), (F.octet_length(content(text)) + 1).cast("bigint").alias("size"),
        F.crc32(content(text)).alias("text_crc32"), F.lit("key").alias("law"),
        placed(F.col(key), tree).alias("shard"), placed(F.col(key), grown(tree)).alias("grown_shard"),
    )
    # stored first: a range partitioning reads its input twice
    rows = handed_over(small, "sharded")
    slotted = with_slots(rows, "shard", [key, "text_crc32", "size"])
    release(rows)
    return slotted.select(
        key, "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint"), "grown_shard"
    )
