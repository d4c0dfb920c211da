"""Texts with nearly the same word shingles, by a prefix join that adapts to its costs.

Shingles have one order for all documents: rare ones first. Two sets of similarity t overlap so
much that the first n - ceil(t n) + m shingles of each, its m-prefix, have at least m in common,
whatever m is. A longer prefix costs more postings but, as more of them must agree, lets fewer
pairs through to the comparison; each document takes the m that it expects to be cheapest.
Two documents of different m must agree in the smaller number.

Documents with equal sets are one. What is asked for are the groups that links connect, so two
documents known to be connected need no comparison: first everybody is compared with one pivot
per posting list, and only pairs that are not connected by that are enumerated. Postings carry a
bitmap of the lists that their document is in, so a pair without its m matches is hardly ever
made, and the first of these lists, so a pair that shares many is made in one of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import collected, handed_over, release
from .components import components
from .shared import FILTER_BITS, content, row_filter, slices, travels, with_pass

travels(__name__)

WORDS, PERCENT = 5, 80
#: Counters of shingle frequencies, hashed: 2**21, a fixed size for a corpus of any size. With
#: many more shingles than counters only shingles well above the mean count as frequent.
SKETCH_BITS, SKETCH_BLOCK = 21, 2**14
#: Largest m, and how many postings one comparison of two sets costs.
LONGEST, COMPARISON = 8, 20.0
#: Rounds of pivots: the second one reaches what the first left beside a large group. The rest is
#: enumerated, whatever its number.
ROUNDS = 2
#: Words of 64 bits in the parity bitmap of a set, and in the bitmap of the lists it is in.
BIT_WORDS = 4
#: Smallest lists that a posting names of its document, so that a pair is made in one of them.
NAMED = 8
BITS = [f"_bits{i}" for i in range(BIT_WORDS)]
LISTS = [f"_lists{i}" for i in range(BIT_WORDS)]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def folded(parts: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash for each sequence of word hashes, its length included."""
    found = np.full(len(parts[0]), len(parts), dtype=np.uint64) * _ODD
    for part in parts:
        found = (found ^ part) * _ODD
        found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text.

    Words are parted by ASCII white space, A-Z count as a-z. With fewer words than a shingle has
    the whole sequence is one; without words there is none.
    """
    spelled = text.encode("utf-8", "replace").lower().split()
    if not spelled:
        return np.zeros(0, dtype=np.int64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in spelled], dtype=np.uint64)
    size = min(words, len(spelled))
    last = len(spelled) - size + 1
    return np.unique(folded([hashes[i:i + last] for i in range(size)])).view(np.int64)


def places(tokens: np.ndarray) -> np.ndarray:
    """Counter of each shingle."""
    return (tokens.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def least_overlap(size: int, percent: int) -> int:
    """Fewest shingles a set of this size shares with a similar one."""
    return -(-size * percent // 100)


def prefix(tokens: np.ndarray, counts: np.ndarray, mean: float, percent: int) -> tuple[np.ndarray, int]:
    """The cheapest m-prefix of a set, rare shingles first, and m."""
    seen = counts[places(tokens)]
    level = np.log2(np.maximum(seen / max(mean, 1.0), 1.0)).astype(np.int64)
    order = np.argsort(level, kind="stable")  # tokens are sorted: ties by hash
    tokens, partners = tokens[order], np.maximum(seen[order] - max(mean, 1.0), 0.0)
    need = least_overlap(len(tokens), percent)
    shortest = len(tokens) - need + 1
    sums = np.cumsum(partners)
    ms = np.arange(1, min(LONGEST, need) + 1)
    chosen = int(ms[np.argmin(sums[shortest + ms - 2] * (1.0 + COMPARISON / ms))])  # ties: the least
    return tokens[: shortest + chosen - 1], chosen


def parity(tokens: np.ndarray) -> list[int]:
    """Which bits an odd number of shingles falls on, as signed 64-bit words.

    Every shingle that only one of two sets has changes one bit, so the sets differ in at least as
    many shingles as their bitmaps do in bits.
    """
    place = (tokens.view(np.uint64) % np.uint64(64 * BIT_WORDS)).astype(np.int64)
    odd = (np.bincount(place, minlength=64 * BIT_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).tolist()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, pa.int64())).cast(
        pa.list_(pa.int64())
    )


def _summaries(texts: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """Size and signature of every document's set, and the frequency counters of all shingles."""
    names = ["_id", "_n", "_s1", "_s2", "_block", "_counts"]
    schema = texts.select("_id").schema.add("_n", "long").add("_s1", "long").add("_s2", "long").add(
        "_block", "long").add("_counts", "binary")

    def summarise(batches):
        counts = np.zeros(2**SKETCH_BITS, dtype=np.int64)
        id_type = None
        for batch in slices(batches):
            id_type = batch.column(0).type
            sizes, first, second = [], [], []
            for text in batch.column(1).to_pylist():
                tokens = shingles(text, words)
                sizes.append(len(tokens))
                both = xxhash.xxh3_128_digest(tokens.tobytes())
                first.append(int.from_bytes(both[:8], "little", signed=True))
                second.append(int.from_bytes(both[8:], "little", signed=True))
                np.add.at(counts, places(tokens), 1)
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary())],
                names=names,
            )
        if id_type is None:
            return
        parts = counts.reshape(-1, SKETCH_BLOCK)
        used = [i for i in range(len(parts)) if parts[i].any()]
        rows = len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(rows, id_type), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()),
             pa.nulls(rows, pa.int64()), pa.array(used, pa.int64()),
             pa.array([zlib.compress(parts[i].astype(np.uint32).tobytes(), 1) for i in used],
                      pa.binary())],
            names=names,
        )

    found = handed_over(texts.mapInArrow(summarise, schema), "summaries")

    def add_up(batches):
        """A running sum per block: the memory of a task does not grow with what it reads."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(packed), dtype=np.uint32).astype(np.int64)
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()),
             pa.array([zlib.compress(s.tobytes(), 1) for s in sums.values()], pa.binary())],
            names=["_block", "_counts"],
        )

    blocks = (
        found.where("_block IS NOT NULL").select("_block", "_counts").repartition("_block")
        .mapInArrow(add_up, "_block long, _counts binary").collect()  # of fixed size
    )
    counts = np.zeros((2**SKETCH_BITS // SKETCH_BLOCK, SKETCH_BLOCK), dtype=np.int64)
    for block, packed in blocks:
        counts[block] = np.frombuffer(zlib.decompress(packed), dtype=np.int64)
    return found, counts.reshape(-1)


def _prefixes(texts: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """Prefix of every set: _id, _n, _m, _tokens, and the words of its parity bitmap."""
    mean = float(counts.mean())
    held = texts.sparkSession.sparkContext.broadcast(counts.astype(np.float32))

    def cut(batches):
        seen = held.value
        for batch in slices(batches):
            sizes, chosen, tokens, bits = [], [], [], []
            for text in batch.column(1).to_pylist():
                whole = shingles(text, words)
                first, m = prefix(whole, seen, mean, percent) if len(whole) else (whole, 0)
                sizes.append(len(whole))
                chosen.append(m)
                tokens.append(first)
                bits.append(parity(whole))
            columns = list(zip(*bits)) if bits else [()] * BIT_WORDS
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(chosen, pa.int32()),
                 _lists(tokens), *[pa.array(c, pa.int64()) for c in columns]],
                names=["_id", "_n", "_m", "_tokens", *BITS],
            )

    schema = texts.select("_id").schema.add("_n", "long").add("_m", "integer").add(
        "_tokens", T.ArrayType(T.LongType()))
    for word in BITS:
        schema = schema.add(word, "long")
    return texts.mapInArrow(cut, schema)


def _sets(texts: DataFrame, words: int) -> DataFrame:
    def whole(batches):
        for batch in slices(batches):
            tokens = [shingles(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(tokens)], names=["_id", "_set"])

    return texts.mapInArrow(whole, texts.select("_id").schema.add("_set", T.ArrayType(T.LongType())))


def _similar_size(n: Column, other: Column, percent: int) -> Column:
    return (F.greatest(n, other) * percent <= F.least(n, other) * 100)


def _slack(n: str, m: str, other_n: str, other_m: str, percent: int) -> Column:
    """How many shingles two sets can share outside the shared part of their prefixes, less how
    many they must share in all.

    One prefix ends before the other in the common order, so what its set shares beyond the
    prefixes lies behind its own: all but its first n - ceil(t n) + m shingles.
    """
    behind = lambda size, held: F.ceil(F.col(size) * percent / 100) - F.col(held)
    need = F.ceil((F.col(n) + F.col(other_n)) * percent / (100 + percent))
    return F.greatest(behind(n, m), behind(other_n, other_m)) - need


def _memberships(rows: DataFrame) -> DataFrame:
    """In how many lists each document is, a bitmap of them, and which are the first: _id, _live,
    the words of the bitmap, _names."""
    first = F.slice(F.sort_array(F.collect_list("_token")), 1, NAMED)
    place = f"pmod(_token, {64 * BIT_WORDS}) div 64"
    return rows.groupBy("_id").agg(F.count("*").alias("_live"), *[
        F.expr(f"bit_or(IF({place} = {i}, shiftleft(1L, int(pmod(_token, 64))), 0L))").alias(word)
        for i, word in enumerate(LISTS)
    ], first.alias("_names"))


def _reachable(left: str, right: str, percent: int) -> Column:
    """Whether two documents can meet in as many lists as similar sets must.

    Every bit that only one document has is at least one of its lists that the other is not in.
    They need the smaller m of meetings, and as many as the rest of their sets cannot make up for.
    """
    def shared(one: str, other: str) -> Column:
        return F.col(f"{one}_live") - sum(
            F.bit_count(F.col(f"{one}{w}").bitwiseAND(F.bitwise_not(F.col(f"{other}{w}"))))
            for w in LISTS
        )

    lists = F.least(shared(left, right), shared(right, left))
    slack = _slack(f"{left}_n", f"{left}_m", f"{right}_n", f"{right}_m", percent)
    return (lists >= F.least(F.col(f"{left}_m"), F.col(f"{right}_m"))) & (lists + slack >= 0)


def _verified(
    pairs: DataFrame, texts: DataFrame, words: int, percent: int, filter_bits: int
) -> DataFrame:
    """The stored pairs (a, b) whose whole sets are similar enough, stored.

    Only documents of a pair are shingled again; their texts stay where they are.
    """
    ids = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id")))
    wanted = handed_over(row_filter(ids, F.col("_id"), filter_bits), "pair-filter")
    passing = with_pass(texts.where("_id IS NOT NULL"), wanted, F.col("_id"), "_go", filter_bits)
    sets = handed_over(_sets(passing.where("_go").select("_id", "_text"), words), "sets")
    ours = sets.select(F.col("_id").alias("a"), F.col("_set").alias("_ours"))
    theirs = sets.select(F.col("_id").alias("b"), F.col("_set").alias("_theirs"))
    met = pairs.select("a", "b").join(ours, "a").join(theirs, "b")
    both = F.size(F.array_intersect("_ours", "_theirs")).cast("long")
    either = F.size("_ours") + F.size("_theirs") - both
    found = handed_over(met.where(both * 100 >= either * percent).select("a", "b"), "found")
    release(wanted, sets)
    return found


def similar_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS,
    percent: int = PERCENT, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document: key, n_shingles, component_id.

    Two documents link if their shingles' Jaccard similarity is at least ``percent`` in a hundred;
    ``component_id`` is the smallest key that links reach, the document's own included. A null
    text counts as empty; empty sets have no links. Keys are taken to be unique: a repeated key
    stands for all its texts. A null key takes part in no link and has a null component.
    """
    texts = docs.select(F.col(key).alias("_id"), content(text).alias("_text"))
    summaries, counts = _summaries(texts, words)
    rows = summaries.where("_block IS NULL").select("_id", "_n", "_s1", "_s2")
    classes = handed_over(
        rows.where("_n > 0 AND _id IS NOT NULL").groupBy("_n", "_s1", "_s2")
        .agg(F.min("_id").alias("_rep")),
        "classes",
    )
    # one document of each class goes on; others that pass the filter change nothing
    reps = handed_over(row_filter(classes, F.col("_rep"), filter_bits), "rep-filter")
    passing = with_pass(texts.where("_id IS NOT NULL"), reps, F.col("_id"), "_go", filter_bits)
    prefixes = handed_over(
        _prefixes(passing.where("_go").select("_id", "_text"), counts, words, percent).where("_n > 0"),
        "prefixes",
    )
    postings = prefixes.select(F.explode("_tokens").alias("_token"), "_id", "_n")
    shared = handed_over(
        postings.groupBy("_token").agg(F.count("*").alias("_d")).where("_d > 1").select("_token"),
        "shared",
    )
    # most shingles are in one document: their postings need not move to be left out
    often = handed_over(row_filter(shared, F.col("_token"), filter_bits), "shared-filter")
    moving = with_pass(postings, often, F.col("_token"), "_go", filter_bits).where("_go").drop("_go")
    live = handed_over(
        moving.join(shared, "_token")
        .join(classes.select(F.col("_rep").alias("_id")), "_id", "left_semi"),
        "live",
    )
    facts = handed_over(
        prefixes.select("_id", "_n", "_m", *BITS).join(_memberships(live), "_id"),
        "facts",
    )
    release(prefixes, shared, often, reps)
    collected(docs.sparkSession)

    def similar(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, texts, words, percent, filter_bits)

    groups = _connected(live, facts, similar, percent)
    release(live, facts)
    in_class = handed_over(
        classes.join(groups, F.col("_rep") == F.col("node"), "left").select(
            "_n", "_s1", "_s2", F.coalesce("component", "_rep").alias("component_id")
        ),
        "grouped",
    )
    alone = rows.where("_n = 0 OR _id IS NULL").select(
        F.col("_id").alias(key), F.col("_n").alias("n_shingles"), F.col("_id").alias("component_id")
    )
    met = rows.where("_n > 0 AND _id IS NOT NULL").join(in_class, ["_n", "_s1", "_s2"]).select(
        F.col("_id").alias(key), F.col("_n").alias("n_shingles"), "component_id"
    )
    return alone.unionByName(met)


def _connected(
    live: DataFrame, facts: DataFrame, similar: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame:
    """Components (node, component) of the documents in posting lists.

    ``facts`` has a row per document: size, m and bitmap of its set, and in which lists it is.
    Rows of lists are many, so they name their document and its size alone until pairs are made.
    """
    links = tried = groups = None
    for number in range(ROUNDS):
        if groups is None:
            some, known = live.withColumn("_group", F.col("_id")), facts
        else:
            some, known = _mixed(live, facts, groups)
        found, tried = _pivot_links(some, known, similar, number, tried, percent)
        if groups is not None:
            release(some, known)
        links = found if links is None else handed_over(links.unionByName(found), "links")
        groups = handed_over(components(links), "groups")
        collected(live.sparkSession)
    some, known = _mixed(live, facts, groups)
    whole = handed_over(some.drop("_n").join(known, "_id"), "whole")
    release(some, known)
    found = _remaining_links(whole, similar, tried, percent)
    release(whole)
    links = found if links is None else links.unionByName(found)
    return handed_over(components(links), "groups")


def _mixed(
    live: DataFrame, facts: DataFrame, groups: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Rows of the lists that hold several groups, with the largest of these, and the facts of
    their documents, both stored.

    Memberships are those in these lists: documents of different groups meet in no other.
    """
    if groups is None:
        held = live.withColumn("_group", F.col("_id"))
    else:
        placed = groups.select(F.col("node").alias("_id"), F.col("component").alias("_group"))
        held = handed_over(
            live.join(placed, "_id", "left").withColumn("_group", F.coalesce("_group", "_id")),
            "placed",
        )
    by_group = held.groupBy("_token", "_group").agg(F.count("*").alias("_d"))
    mixed = by_group.groupBy("_token").agg(
        F.count("*").alias("_groups"),
        F.max_by("_group", F.struct("_d", "_group")).alias("_largest"),
    ).where("_groups > 1")
    some = handed_over(held.join(mixed.select("_token", "_largest"), "_token"), "in-mixed")
    known = handed_over(
        facts.drop("_live", "_names", *LISTS).join(_memberships(some), "_id"), "memberships"
    )
    if groups is not None:
        release(held)
    return some, known


def _differing(left: str, right: str) -> Column:
    """Bits in which two bitmaps differ: at most the shingles in which their sets do."""
    return sum(
        F.bit_count(F.col(f"{left}{w}").bitwiseXOR(F.col(f"{right}{w}"))) for w in BITS
    )


def _most_differing(n: str, other: str, percent: int) -> Column:
    """Shingles in which sets of these sizes may differ and still be similar."""
    both = F.col(n) + F.col(other)
    return both - 2 * F.ceil(both * percent / (100 + percent))


def _pivot_links(
    some: DataFrame, facts: DataFrame, similar: Callable[[DataFrame], DataFrame], number: int,
    tried: DataFrame | None, percent: int,
) -> tuple[DataFrame, DataFrame]:
    """Compare every document with the most alike, by its bitmap, of its lists' pivots.

    Each list draws its own pivot in each round, from its largest group once there is one, so a
    document meets as many of a large group as it has shingles in common with it. A pair that
    meets in many lists gets its bitmaps once.
    """
    outside = F.lit(False) if number == 0 else F.col("_group") != F.col("_largest")
    draw = F.struct(outside.alias("outside"), F.xxhash64("_id", "_token", F.lit(number)).alias("draw"))
    pivots = handed_over(
        some.groupBy("_token").agg(F.min(F.struct(
            draw.alias("draw"), F.col("_id").alias("_p_id"), F.col("_group").alias("_p_group"),
            F.col("_n").alias("_p_n"),
        )).alias("_pivot")).select("_token", "_pivot.*").drop("draw"),
        "pivots",
    )
    met = some.join(pivots, "_token").where(
        (F.col("_group") != F.col("_p_group")) & _similar_size(F.col("_n"), F.col("_p_n"), percent)
    ).select("_id", "_p_id").distinct()
    ours = facts.drop("_names")
    theirs = ours.withColumnsRenamed({c: f"_p{c}" for c in ours.columns})
    pairs = met.join(ours, "_id").join(theirs, "_p_id").withColumn("_far", _differing("", "_p")).where(
        _similar_size(F.col("_n"), F.col("_p_n"), percent) & _reachable("", "_p", percent)
        & (F.col("_far") <= _most_differing("_n", "_p_n", percent))
    )
    if tried is not None:
        known = tried.select(F.col("a").alias("_id"), F.col("b").alias("_p_id"))
        pairs = pairs.join(known, ["_id", "_p_id"], "left_anti")
    best = handed_over(
        pairs.groupBy(F.col("_id").alias("a")).agg(
            F.min_by("_p_id", F.struct("_far", "_p_id")).alias("b")),
        "best",
    )
    found = similar(best)
    release(pivots)
    return found, best if tried is None else handed_over(tried.unionByName(best), "tried")


def _meetings(some: DataFrame, percent: int) -> DataFrame:
    """Two documents of different groups that share lists, ``_a`` and ``_b``.

    Of the lists that both documents name, they meet in the first only; documents that name none
    in common meet in every list that they share.

    A pair of different groups has at least one document outside the largest group of the list,
    so that side is the smaller one. Pairs whose bitmaps differ in more bits than their sets may
    differ in shingles are left out while the lists are met, and so are pairs that cannot be in
    enough lists together.
    """
    left = some.where("_group <> _largest").select(
        "_token", F.col("_id").alias("_a"), F.col("_names").alias("_a_names"),
        *[F.col(c).alias(f"_a{c}") for c in ("_n", "_m", "_live", *BITS, *LISTS)],
        F.col("_group").alias("_a_group"),
    )
    right = some.select(
        "_token", F.col("_id").alias("_b"), F.col("_names").alias("_b_names"),
        *[F.col(c).alias(f"_b{c}") for c in ("_n", "_m", "_live", *BITS, *LISTS)],
        F.col("_group").alias("_b_group"), (F.col("_group") == F.col("_largest")).alias("_b_large"),
    )
    return left.join(right, "_token").where(
        _reachable("_a", "_b", percent)
        & (_differing("_a", "_b") <= _most_differing("_a_n", "_b_n", percent))
        & (F.col("_a_group") != F.col("_b_group")) & (F.col("_b_large") | (F.col("_a") < F.col("_b")))
        & _similar_size(F.col("_a_n"), F.col("_b_n"), percent)
        & F.coalesce(F.array_min(F.array_intersect("_a_names", "_b_names")) == F.col("_token"),
                     F.lit(True))
    )


def _remaining_links(
    some: DataFrame, similar: Callable[[DataFrame], DataFrame], tried: DataFrame | None,
    percent: int,
) -> DataFrame:
    """All links between documents of different groups."""
    met = handed_over(
        _meetings(some, percent)
        .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
        "met",
    )
    lists = _lists_of(met, some)
    pairs = _matching(met, lists, percent)
    if tried is not None:
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = pairs.join(known, ["a", "b"], "left_anti")
    pairs = handed_over(pairs, "pairs")
    found = similar(pairs)
    release(met, lists, pairs)
    return found


def _lists_of(pairs: DataFrame, some: DataFrame) -> DataFrame:
    """All lists of every document of the pairs, stored: _id, _n, _m, _in."""
    ids = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id")))
    return handed_over(
        some.join(ids.distinct(), "_id", "left_semi").groupBy("_id", "_n", "_m")
        .agg(F.collect_list("_token").alias("_in")),
        "lists",
    )


def _matching(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share as many lists as their m and their sizes ask for."""
    ours, theirs = [
        lists.select(F.col("_id").alias(side), *[F.col(c).alias(f"_{side}{c}") for c in ("_n", "_m", "_in")])
        for side in "ab"
    ]
    shared = F.size(F.array_intersect("_a_in", "_b_in"))
    slack = _slack("_a_n", "_a_m", "_b_n", "_b_m", percent)
    return pairs.join(ours, "a").join(theirs, "b").where(
        (shared >= F.least("_a_m", "_b_m")) & (shared + slack >= 0)
    ).select("a", "b")
