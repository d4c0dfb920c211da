"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Distances are taken on Walsh-Hadamard coefficients. The transform of whole numbers is whole, and
keeps squared distances but for a factor, the padded width of a part. Coefficients are added in
sequency order, the slowest first, in which smooth parts have most of their size; an entry leaves
as soon as what was added exceeds the whole distance of some other entry. Everything is 64-bit
integer arithmetic, so the nearest entry is exact and ties go to the smaller index.

Rows stay in their tasks. A round sends the codebooks out and gets counts and sums per entry
back, whose number depends on the sizes of the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import handed_over, release
from .shared import slices, travels
from .vectors import check_room, usable, whole, width_of

#: Rows taken apart at a time.
SLICE = 4096
#: Coefficients read of all entries before the first ones leave.
LEAD = 2
SUMS = "part int, entry int, place int, n long, total long"
CODED = "id long, label {label}, code string, error long"


def padded_width(width: int) -> int:
    return 1 << max(width - 1, 0).bit_length()


def by_sequency(width: int) -> np.ndarray:
    """Places of the coefficients in order of their sign changes, for a power of two."""
    bits = width.bit_length() - 1
    places = np.arange(width)
    gray, out = places ^ (places >> 1), np.zeros(width, dtype=np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def walsh(values: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the last axis in sequency order, zero-padded, unscaled."""
    *lead, width = values.shape
    size = padded_width(width)
    out = np.zeros((*lead, size), dtype=np.int64)
    out[..., :width] = values
    half = 1
    while half < size:
        pairs = out.reshape(*lead, size // (2 * half), 2, half)
        a, b = pairs[..., 0, :].copy(), pairs[..., 1, :].copy()
        pairs[..., 0, :], pairs[..., 1, :] = a + b, a - b
        half *= 2
    return out[..., by_sequency(size)]


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for every vector, and the squared distance.

    Both come transformed, so distances are a multiple of the padded width.
    """
    n, size = vectors.shape
    lead = min(LEAD, size)
    partial = np.zeros((n, len(entries)), dtype=np.int64)
    for s in range(lead):
        partial += (vectors[:, s, None] - entries[None, :, s]) ** 2
    # whichever entry leads so far, its whole distance is one the nearest cannot exceed
    pilot = entries[partial.argmin(axis=1)]
    bound = ((vectors - pilot) ** 2).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    left = partial[row, entry]
    for s in range(lead, size):
        left += (vectors[row, s] - entries[entry, s]) ** 2
        stay = left <= bound[row]
        if not stay.all():
            row, entry, left = row[stay], entry[stay], left[stay]
    # pairs stand by row and entry: the first least of a row has the smallest index
    least = np.minimum.reduceat(left, np.searchsorted(row, np.arange(n)))
    at = np.flatnonzero(left == least[row])
    _, first = np.unique(row[at], return_index=True)
    return entry[at[first]], least // size


def parts_of(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """Rows of an Arrow list column as (rows, parts, width), filled up with 0."""
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    out = np.zeros((len(sizes), parts * width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(sizes.cumsum() - sizes, sizes)
    out[row, place] = flat
    return out.reshape(len(sizes), parts, width)


def _assigned(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances, both (rows, parts)."""
    found = [nearest(walsh(vectors[:, p]), walsh(books[p])) for p in range(len(books))]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def summing(books: np.ndarray) -> Callable[[Iterator], Iterator]:
    """Counts and sums of the parts that each entry got in a task."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), dtype=np.int64)
        totals = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in slices(batches, SLICE):
            vectors = parts_of(batch.column("q"), parts, width)
            codes, _ = _assigned(vectors, books)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(totals[p], codes[:, p], vectors[:, p])
        part, entry = np.nonzero(counts)
        if len(part):
            spread = lambda x: np.repeat(x, width)
            yield pa.record_batch({
                "part": pa.array(spread(part), pa.int32()),
                "entry": pa.array(spread(entry), pa.int32()),
                "place": pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
                "n": spread(counts[part, entry]), "total": totals[part, entry].ravel(),
            })

    return run


def coding(books: np.ndarray) -> Callable[[Iterator], Iterator]:
    """Code and error of every row."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE):
            codes, errors = _assigned(parts_of(batch.column("q"), parts, width), books)
            spelled = codes.astype(np.uint8).tobytes().hex()
            step = 2 * parts
            yield pa.record_batch({
                "id": batch.column("id"), "label": batch.column("label"),
                "code": [spelled[i: i + step] for i in range(0, step * len(codes), step)],
                "error": errors.sum(axis=1),
            })

    return run


def trained(stored: DataFrame, first: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks (parts, entries, width) after so many rounds from the first ones."""
    books = first.copy()
    for _ in range(rounds):
        sums = stored.select("q").mapInArrow(summing(books), SUMS)
        got = sums.groupBy("part", "entry", "place").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total")
        )
        for r in got.collect():  # as many rows as the codebooks have components
            books[r.part, r.entry, r.place] = r.total // r.n
    return books


def compressed(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6,
) -> DataFrame:
    """One row per vector: id, label, code, error, label_error, codebooks_sha256.

    Components become ``floor(scale * x)``. Codebooks start as the parts of the rows with the
    smallest keys; a round gives every part to its nearest entry and puts each entry at the floor
    of its parts' mean, an entry without parts staying where it is. ``code`` has two hex digits a
    part, ``error`` is the squared distance over all parts, ``label_error`` its sum over the rows
    of a label, rows without one together.

    Rows whose vector is null or has a component that is null or not finite are dropped. Shorter
    vectors, and widths that the parts do not divide, are filled up with 0 at the end. With fewer
    rows than entries there are as many entries as rows. Rows that repeat a key are rows of their
    own; among equal keys the smaller vector comes first, null keys come last. No rows give no
    rows. Further columns of the input are not read. Components so large that a sum of squares
    would leave 64 bits are an error.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    named = rows.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).alias("label"),
        F.col(vector).alias("v"),
    ).where(usable("v"))
    stored = handed_over(named.select("id", "label", whole("v", scale).alias("q")), "whole")
    width = max(-(-width_of(stored, "q") // parts), 1)
    size = padded_width(width)
    largest = stored.agg(F.max(F.array_max(F.transform("q", F.abs)))).first()[0] or 0
    # a coefficient is a sum of a part, and a difference of two of them is squared
    check_room(2 * size * largest, size * parts)
    start = stored.orderBy(F.asc_nulls_last("id"), "q").limit(entries).select("q").toArrow()
    first = parts_of(start.column("q").combine_chunks(), parts, width).transpose(1, 0, 2)
    books = trained(stored, first, rounds) if first.size else first
    spelled = ",".join(map(str, books.ravel().tolist()))
    kind = dict(stored.dtypes)["label"]
    coded = handed_over(stored.mapInArrow(coding(books), CODED.format(label=kind)), "coded")
    release(stored)
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return (
        coded.join(of_label.withColumnRenamed("label", "_of"),
                   F.col("label").eqNullSafe(F.col("_of")))
        .select("id", "label", "code", "error", "label_error",
                F.lit(hashlib.sha256(spelled.encode()).hexdigest()).alias("codebooks_sha256"))
    )


travels(__name__)
