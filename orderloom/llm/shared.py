"""What several of the document operators need."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..session import handed_over

#: Bits of a row filter: 2**26 bits are 8 MB, sent to every executor.
FILTER_BITS = 2**26
#: Rows that a Python worker takes apart at a time.
SLICE_ROWS = 500
#: One row of Spark's bitmap functions holds so many bits.
BITMAP = 32768


def travels(module: str) -> None:
    """Send this module's functions to the workers by value: they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def slices(batches: Iterator, rows: int = SLICE_ROWS) -> Iterator:
    """The same rows in smaller Arrow batches, which bounds what a Python worker holds at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def content(text: str = "text") -> Column:
    """A text, null counting as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def row_filter(keys: DataFrame, key: Column, bits: int = FILTER_BITS) -> DataFrame:
    """A bitmap over the hashes of keys: at most ``bits / 32768`` rows of 4 KB, so its size is
    bounded however many keys there are. With far more keys than bits it lets everything pass;
    what reads it must be right in either case.

    Its bytes are given as 64-bit words, the first byte of eight the highest, because each row
    that is looked up takes one bit: a word is an array element, a byte would be spelled out.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    words = F.expr(
        f"transform(sequence(0, {BITMAP // 64 - 1}),"
        " i -> bigint(conv(hex(substring(_bitmap, i * 8 + 1, 8)), 16, -10)))"
    )
    return (
        keys.select(place.alias("_place")).distinct()
        .groupBy(F.expr(f"_place div {BITMAP}").alias("_block"))
        .agg(F.expr(f"bitmap_construct_agg(_place % {BITMAP})").alias("_bitmap"))
        .select("_block", words.alias("_words"))
    )


def with_pass(
    rows: DataFrame, filtered: DataFrame, key: Column, out: str, bits: int = FILTER_BITS
) -> DataFrame:
    """Marks rows that may be among the filter's keys; rows that are among them always pass.

    The filter is broadcast (its size is bounded, see above), so the rows stay where they are.
    """
    # a place that could be null would be filtered where rows are read, and hashed twice
    place = F.coalesce(F.pmod(F.xxhash64(key), F.lit(bits)), F.lit(0))
    placed = rows.withColumn("_place", place)
    blocks = F.broadcast(filtered.withColumnRenamed("_block", "_of"))
    word = f"get(_words, int(_place % {BITMAP} div 64))"
    hit = F.expr(f"getbit({word}, int(_place % 64) ^ 56)") == 1  # the first byte is the highest
    return (
        placed.join(blocks, F.expr(f"_place div {BITMAP}") == F.col("_of"), "left")
        .withColumn(out, F.coalesce(hit, F.lit(False)))
        .drop("_place", "_of", "_words")
    )


def without_keys(
    rows: DataFrame, keys: DataFrame, key: str, bits: int = FILTER_BITS
) -> DataFrame:
    """Rows whose key is not among the keys; rows with a null key stay.

    Only rows that may have such a key are joined, so most texts stay where they are.
    """
    gone = handed_over(keys.select(F.col(key).alias("_gone")).distinct(), "gone")
    filtered = handed_over(row_filter(gone, F.col("_gone"), bits), "gone-filter")
    packed = rows.select(F.struct(*rows.columns).alias("_row"), F.col(key).alias("_key"))
    marked = with_pass(packed, filtered, F.col("_key"), "_go", bits)
    moved = marked.where("_go").join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    return marked.where("NOT _go").unionByName(moved).select("_row.*")


travels(__name__)
