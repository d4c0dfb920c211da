"""Passages of a benchmark in documents, small changes included.

With a budget of k edits an item is cut into k + 1 pieces: a text within k edits of it must hold
one of the pieces unchanged. An automaton finds all pieces of all items in one pass over a
document, and around each hit Myers' bit-parallel method computes the distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import slices, travels

travels(__name__)

BETWEEN_WORDS = re.compile(r"[\W_]+")
#: Edits allowed, as a share of the item's length.
ERROR_SHARE = 0.05
#: Items shorter than this, in normalised characters, count where they stand as whole words; 5 % of
#: them is no edit. Letters from UNSPACED on (Chinese, Japanese, Korean) are words of their own.
WHOLE_WORDS = 20
UNSPACED = "\u2e80"
#: Items are sent to the workers in blocks of so many normalised characters.
BLOCK = 4_000_000
HITS = "array<struct<item_id:bigint,distance:int>>"


def normalised(text: str) -> str:
    """Lower case, words parted by single spaces, everything else gone."""
    return BETWEEN_WORDS.sub(" ", text.lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` parts of nearly equal length with their places."""
    bounds = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:])]


def between_words(text: str, at: int) -> bool:
    """Whether no word of a normalised text goes on from the letter before a place to the next."""
    return not 0 < at < len(text) or any(c == " " or c >= UNSPACED for c in text[at - 1:at + 1])


def letter_masks(item: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for place, letter in enumerate(item):
        found[letter] = found.get(letter, 0) | 1 << place
    return found


def least_distance(masks: dict[str, int], length: int, text: str) -> int:
    """Least number of edits between an item and any part of a text.

    One bit per letter of the item: whether the distance rises or falls from this letter to the
    next, all letters updated at once for each letter of the text.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    rises, falls, distance = full, 0, length
    least = distance
    for letter in text:
        equal = masks.get(letter, 0)
        vertical = equal | falls
        horizontal = (((equal & rises) + rises) ^ rises) | equal
        up = falls | ~(horizontal | rises) & full
        down = rises & horizontal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
            if distance < least:
                least = distance
        up, down = up << 1 & full, down << 1 & full  # a match may start anywhere
        rises = down | ~(vertical | up) & full
        falls = up & vertical
    return least


class Finder:
    """Items of one block, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], error_share: float):
        self.items = [
            (number, letter_masks(text), len(text), int(len(text) * error_share))
            for number, text in items
        ]
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text) in enumerate(items):
            for place, piece in pieces(text, self.items[at][3]):
                found.setdefault(piece, []).append((at, place))
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def hits(self, text: str) -> dict[int, int]:
        """Distance of each item that the text holds within its budget."""
        plain = normalised(text)
        found: dict[int, int] = {}
        windows: set[tuple[int, int]] = set()
        if not self.items:
            return found
        for end, (size, uses) in self.automaton.iter(plain):
            for at, place in uses:
                number, masks, length, budget = self.items[at]
                start = end + 1 - size - place - budget
                if found.get(number) == 0 or (at, start) in windows:
                    continue
                if length < WHOLE_WORDS and not (
                    between_words(plain, end + 1) and between_words(plain, end + 1 - size)
                ):
                    continue  # without a budget the only piece is the item itself
                windows.add((at, start))
                window = plain[max(0, start):start + length + 2 * budget]
                distance = least_distance(masks, length, window)
                if distance <= budget:
                    found[number] = min(distance, found.get(number, distance))
        return found


def blocks(items: DataFrame, text: str, key: str, block: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of bounded size; equal texts once each, under all their keys."""
    held, size = [], 0
    for row in items.select(key, text).toLocalIterator():
        plain = normalised(row[1] or "")
        if row[0] is None or not plain:
            continue
        if held and size + len(plain) > block:
            yield held
            held, size = [], 0
        held.append((row[0], plain))
        size += len(plain)
    yield held


def with_hits(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text",
    item_key: str = "item_id", error_share: float = ERROR_SHARE, block: int = BLOCK,
    keep_text: bool = True,
) -> DataFrame:
    """All columns, and ``hits``: the items that the text holds within their budget of edits, with
    the least distance found, in the order of their keys.

    Rows stay where they are. Items are a stated set, sent in blocks of bounded size; each block
    is one more pass over the rows. A null text holds nothing; items that are null or have no word
    are ignored, short ones must stand in the text as whole words. A column ``hits`` is replaced.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != "hits"]
    rows = docs.select(*others, F.expr(f"CAST(array() AS {HITS})").alias("hits"))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))
    for number, some in enumerate(blocks(items, item_text, item_key, block)):
        held = spark.sparkContext.broadcast({"items": some})

        def look(batches, held=held):
            value = held.value
            finder = value.get("finder")
            if finder is None:  # one for all tasks of a worker
                finder = value["finder"] = Finder(value["items"], error_share)
            for batch in slices(batches):
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                before = batch.column(batch.schema.get_field_index("hits")).to_pylist()
                after = [
                    sorted(
                        old + [{"item_id": k, "distance": d} for k, d in finder.hits(t or "").items()],
                        key=lambda h: h["item_id"],
                    )
                    for t, old in zip(texts, before)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(batch.schema.get_field_index(c)) for c in others],
                     pa.array(after, kind)],
                    names=[*others, "hits"],
                )

        rows = rows.mapInArrow(look, rows.schema)
    return rows if keep_text else rows.drop(text)
