"""Lines that recur across documents, found by a tree of line templates.

A line descends a tree of fixed depth: by its number of tokens, then by its leading tokens. In
the leaf it reaches, a token that many texts have at the same place is a constant; every other
token, and any token with a digit, is a variable field. The line's template is its constants and
their places. Templates that many different texts share are boilerplate. How many are many is a
matter of levels: the longer the lines and the larger the share of constants, the fewer texts do.
Lines with digits that are equal as a whole recur also where they have too few constants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import handed_over, release
from .shared import FILTER_BITS, content, row_filter, with_pass

#: Leading tokens that the tree descends by.
DEPTH = 3
#: Different texts that must share a constant, and a template.
LEAST_TEXTS = 10
#: Lines of a token or two have leaves too, their tokens; blank lines, of white space alone, have none.
LEAST_TOKENS = 1
#: Share of a line's tokens that must be constants, in a hundred.
CONSTANT_PERCENT = 60
#: Further levels: texts that suffice for lines of so many tokens, of which so many in a hundred
#: are constants. A level's fewer texts hold for its constants too.
FIRMER = ((5, 8, 80), (3, 20, 90), (2, 50, 90))
FIELD = "<*>"


def _tokens(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _lines(docs: DataFrame, depth: int, least_tokens: int) -> DataFrame:
    """_id, _text_hash, _at, _line (trimmed), _size (its tokens), _leaf of every line that has a
    template.

    Lines are not taken apart here: with single spaces, which most have, their number and the
    leading tokens are the rest.
    """
    split = docs.select("_id", "_text_hash", F.posexplode(F.split("_text", "\n")).alias("_at", "_line"))
    line = F.col("_line")
    # most lines begin with a visible ASCII letter, which a comparison tells without a pattern
    written = split.where(((line >= "!") & (line < "\x7f")) | line.rlike(r"(?U)\S"))
    spaced = line.contains("  ")
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    sized = written.withColumn("_line", F.trim("_line")).select(
        "_id", "_text_hash", "_at", "_line",
        F.when(spaced, F.size(_tokens(line))).otherwise(spaces + 1).alias("_size"),
        F.when(spaced, F.slice(_tokens(line), 1, depth))
        .otherwise(F.slice(F.split(F.substring_index(line, " ", depth), " "), 1, depth)).alias("_first"),
    )
    fields = F.transform("_first", lambda t: F.when(t.rlike("[0-9]"), FIELD).otherwise(t))
    lead = F.when(F.array_join("_first", " ").rlike("[0-9]"), fields).otherwise(F.col("_first"))
    found = sized.where(F.col("_size") >= least_tokens) if least_tokens > 1 else sized
    return found.withColumn("_leaf", F.xxhash64("_size", lead)).drop("_first")


def _common(rows: DataFrame, keys: list[str], least: Column) -> DataFrame:
    """Keys that at least so many different texts have; copies of a text count once."""
    return (
        rows.select(*keys, "_text_hash").distinct()
        .groupBy(*keys).agg(F.count("*").alias("_texts")).where(F.col("_texts") >= least)
    )


def _fewest(size: Column, levels: tuple[tuple[int, int, int], ...]) -> Column:
    """The texts that the easiest level asks for of lines of this size, which some level takes.

    Never null: Spark would filter nulls out where lines are read, and size them once more a level.
    """
    takes = F.array(*[F.when(size >= tokens, texts) for texts, tokens, _ in levels])
    return F.coalesce(F.array_min(takes), F.lit(levels[0][0]))


def recurring_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", depth: int = DEPTH,
    least_texts: int = LEAST_TEXTS, least_tokens: int = LEAST_TOKENS,
    constant_percent: int = CONSTANT_PERCENT, filter_bits: int = FILTER_BITS,
    firmer: tuple[tuple[int, int, int], ...] = FIRMER,
) -> DataFrame:
    """Lines to drop: _id, _text_hash, _at (from 0), _template; one row per line.

    The first occurrence of a template, by key and place, is not among them, so nothing
    disappears from the corpus altogether: a level that asks for fewer texts has all constants of
    one that asks for more, its templates part those of the other, and the first line of the
    widest template is the first of all its templates.
    """
    levels = ((least_texts, least_tokens, constant_percent), *firmer)
    texts = docs.select(F.col(key).alias("_id"), content(text).alias("_text")).withColumn(
        "_text_hash", F.xxhash64("_text")
    )
    lines = _lines(texts, depth, min(tokens for _, tokens, _ in levels))
    lines = lines.withColumn("_fewest", _fewest(F.col("_size"), levels))
    leaves = handed_over(
        _common(lines, ["_leaf", "_fewest"], F.col("_fewest")).select("_leaf"), "leaves"
    )
    in_leaf = handed_over(row_filter(leaves, F.col("_leaf"), filter_bits), "leaf-filter")
    # only lines of common leaves are looked at; a few others pass the filter and change nothing
    picked = handed_over(
        with_pass(lines, in_leaf, F.col("_leaf"), "_go", filter_bits).where("_go").select(
            "_id", "_text_hash", "_at", "_leaf", "_fewest", _tokens(F.col("_line")).alias("_tokens"),
            F.col("_line").rlike("[0-9]").alias("_digits"),
        ).withColumn("_line", F.xxhash64("_tokens")),
        "picked",
    )
    # a spot is a token at its place in a leaf
    spots = F.posexplode("_tokens").alias("_place", "_token")
    spot = F.xxhash64("_leaf", "_place", "_token").alias("_spot")
    fixed = ~(F.col("_digits") & F.col("_token").rlike("[0-9]"))
    constants = handed_over(
        _common(
            picked.select("_leaf", "_text_hash", "_fewest", "_digits", spots).where(fixed)
            .select(spot, F.col("_fewest").cast("byte").alias("_fewest"), "_text_hash"),
            ["_spot", "_fewest"], F.col("_fewest"),
        ).select("_spot", "_texts"),
        "constants",
    )
    # equal lines of a leaf have equal templates, so each is taken apart once, and of its tokens
    # those that may be constants move
    unique = handed_over(
        picked.groupBy("_leaf", "_line").agg(
            F.any_value("_tokens").alias("_tokens"), F.any_value("_digits").alias("_digits")
        ),
        "unique",
    )
    in_constants = handed_over(row_filter(constants, F.col("_spot"), filter_bits), "spot-filter")
    cells = unique.select(
        "_leaf", "_line", "_digits", F.size("_tokens").alias("_size"), spots
    ).where(fixed)
    cells = with_pass(
        cells.select("_leaf", "_line", "_size", spot), in_constants, F.col("_spot"), "_go", filter_bits
    ).where("_go").drop("_go")
    # dealt out by line while the rows are narrow; a line has no more of them than tokens
    held = cells.join(constants, "_spot").repartition("_leaf", "_line")
    by_level = held.groupBy("_leaf", "_line").agg(F.any_value("_size").alias("_size"), *[
        F.struct(
            F.lit(least).alias("least"), F.lit(tokens).alias("tokens"), F.lit(percent).alias("percent"),
            F.count_if(F.col("_texts") >= least).alias("held"),
            F.bit_xor(F.when(F.col("_texts") >= least, F.col("_spot"))).alias("pattern"),
        ).alias(f"_level{n}") for n, (least, tokens, percent) in enumerate(levels)
    ])
    by_template = handed_over(
        by_level.select(
            "_leaf", "_line", "_size",
            F.explode(F.array(*[f"_level{n}" for n in range(len(levels))])).alias("_of"),
        )
        .where("_size >= _of.tokens AND _of.held > 0 AND _of.held * 100 >= _size * _of.percent")
        .select(
            "_leaf", "_line", F.col("_of.least").alias("_least"),
            F.xxhash64("_leaf", "_of.least", "_of.held", "_of.pattern").alias("_template"),
        ),
        "line-templates",
    )
    places = picked.select("_id", "_text_hash", "_at", "_leaf", "_line")
    # constants leave digits out; a line that is equal as a whole needs none
    whole = picked.where("_digits").select(
        "_id", "_text_hash", "_at", F.col("_fewest").alias("_least"),
        F.xxhash64("_leaf", F.lit("whole"), "_tokens").alias("_template"),
    )
    # both sides come straight from files: AQE may split the places of a very common line
    lined = handed_over(
        places.join(by_template, ["_leaf", "_line"]).select(*whole.columns).unionByName(whole),
        "lined",
    )
    release(leaves, in_leaf, picked, constants, unique, in_constants, by_template)
    firsts = lined.groupBy("_template").agg(
        F.min(F.struct("_id", "_at", "_text_hash")).alias("_first")
    )
    common = handed_over(
        _common(lined, ["_template", "_least"], F.col("_least")).join(firsts, "_template").select("_template", "_first"),
        "templates",
    )
    same = (
        F.col("_id").eqNullSafe(F.col("_first")["_id"]) & (F.col("_at") == F.col("_first")["_at"])
        & (F.col("_text_hash") == F.col("_first")["_text_hash"])
    )
    return (
        lined.join(common, "_template").where(~same)
        .groupBy("_id", "_text_hash", "_at").agg(F.min("_template").alias("_template"))
    )


def without_recurring_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", filter_bits: int = FILTER_BITS,
    **how,
) -> DataFrame:
    """All columns, the text without recurring lines, and n_lines and n_dropped.

    Lines are parted by line feeds. Rows without a recurring line keep their text as it is; a null
    text stays null and has one empty line, as the empty text has. Rows that repeat key and text
    are treated alike. A text all of whose lines recur elsewhere becomes empty.
    """
    places = handed_over(
        recurring_lines(docs, text, key, filter_bits=filter_bits, **how)
        .groupBy("_id", "_text_hash").agg(F.collect_set("_at").alias("_drop")),
        "places",
    )
    touched = row_filter(places, F.struct("_id", "_text_hash"), filter_bits)
    touched = handed_over(touched, "touched")
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(
        F.struct(*others).alias("_row"), F.col(key).alias("_key"),
        F.xxhash64(content(text)).alias("_hash"),
    )
    # the filter was built from a struct of these two
    pair = F.struct(F.col("_key").alias("_id"), F.col("_hash").alias("_text_hash"))
    marked = with_pass(rows, touched, pair, "_go", filter_bits)
    # texts without such a line stay where they are
    still = marked.where("NOT _go").select("_row", F.lit(None).cast("array<int>").alias("_drop"))
    moved = marked.where("_go").join(
        places, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text_hash")), "left"
    ).select("_row", "_drop")
    lines = F.split(F.coalesce(F.col("_row")[text], F.lit("")), "\n")
    kept = F.filter(lines, lambda line, at: ~F.array_contains("_drop", at))
    cut = F.when(F.col("_drop").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("_row")[text])
    return still.unionByName(moved).select(
        *[(cut if c == text else F.col("_row")[c]).alias(c) for c in others],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
