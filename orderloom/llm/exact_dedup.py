"""Exact duplicates by progressive refinement: length, hash of the beginning, hash of the whole.

Every step looks only at rows that the step before could not tell apart. Texts are never
shuffled: what moves is an id, a length and a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import handed_over, release
from .shared import FILTER_BITS, content, row_filter, with_pass

#: Characters of the beginning that the second step hashes.
HEAD = 256


def exact_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", head: int = HEAD,
    digest_all: bool = False, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, digest.

    Texts are equal when they are the same string; a null text counts as empty, and empty texts
    are equal to each other. The largest key of a group stays. Rows that repeat a text together
    with its key cannot be told apart and share their mark; null keys stay only in a group
    without any other key. ``digest`` is the SHA-256 of the text, left null for texts that an
    earlier step found to be unique unless ``digest_all`` is set.
    """
    sized = docs.select(F.col(key).alias("_id"), content(text).alias("_text")).select(
        "_id", "_text", F.octet_length("_text").alias("_length")
    )
    lengths = handed_over(
        row_filter(
            sized.groupBy("_length").agg(F.count("*").alias("_n")).where("_n > 1"),
            F.col("_length"), filter_bits,
        ),
        "lengths",
    )
    # only texts whose length occurs again have their beginning hashed
    sized = with_pass(sized, lengths, F.col("_length"), "_again", filter_bits).withColumn(
        "_head", F.when(F.col("_again"), F.xxhash64(F.substring("_text", 1, head)))
    )
    heads = (
        sized.where("_again").groupBy("_length", "_head").agg(F.count("*").alias("_n"))
        .where("_n > 1")
    )
    same_head = handed_over(
        row_filter(heads, F.struct("_length", "_head"), filter_bits), "same-head"
    )
    sized = with_pass(sized, same_head, F.struct("_length", "_head"), "_open", filter_bits)
    whole = F.sha2("_text", 256)
    rows = handed_over(
        sized.select(
            "_id", "_length", "_open", (whole if digest_all else F.when(F.col("_open"), whole)).alias("digest")
        ),
        "digests",
    )
    release(lengths, same_head)
    groups = handed_over(
        rows.where("_open").groupBy("_length", "digest")
        .agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size")),
        "groups",
    )
    # the groups come straight from a file, so that AQE may split the rows of a hot group
    alone = rows.where("NOT _open").select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "digest"
    )
    met = rows.where("_open").join(groups, ["_length", "digest"]).select(*alone.columns)
    return alone.unionByName(met).select(
        F.col("_id").alias(key), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest",
    )
