"""Hard negatives by a vertical scan: dimensions are columns, read by falling weight.

Each task holds its rows as columns. For an anchor it reads the columns in the order of the
anchor's magnitudes, and after every few of them it knows between which bounds the score of a row
must end: what was read, plus the least and the most that the columns not yet read can add.
Rows whose bounds miss every wanted window, or that enough surer rows are certain to beat, leave
the candidate bitmap. The scores of what is left are exact.

Anchors go to the tasks in blocks of fixed size, one block a round, so a round broadcasts a
bounded number of vectors however many anchors there are; the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.ranking import with_position
from ..session import fresh_path, handed_over, release
from .shared import travels
from .vectors import check_room, usable, whole, width_of

#: Anchors of one round: 4,096 anchors of 64 dimensions are 2 MB.
ANCHORS = 4096
#: Columns read between two looks at the bounds.
STEP = 8
#: Scores fit a long with room to spare (``check_room``).
LEAST, MOST = -(2**62), 2**62
FOUND = "place long, slot int, id long, score long"


class Wanted(NamedTuple):
    """An anchor and the windows of scores that are wanted for it, both ends included."""

    place: int
    id: int
    label: object
    vector: np.ndarray
    windows: tuple[tuple[int, int, int], ...]


class Columns:
    """A block of rows by dimension, with the extent of every dimension."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.ids = batch.column(0).to_numpy()
        self.labels = np.array(batch.column(1).to_pylist(), dtype=object)
        self.values = np.empty((width, batch.num_rows), dtype=np.int64)
        for d in range(width):
            self.values[d] = batch.column(2 + d).to_numpy()
        self.least, self.most = self.values.min(axis=1), self.values.max(axis=1)
        self._of_label: dict = {}

    def of_label(self, label) -> np.ndarray:
        if label not in self._of_label:
            self._of_label[label] = self.labels == label
        return self._of_label[label]


class Best:
    """The best rows of a window so far: highest score first, then the smallest id."""

    def __init__(self, low: int, high: int, top: int):
        self.low, self.high, self.top = low, high, top
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        first = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[first], ids[first]

    @property
    def floor(self) -> int:
        """Score below which a row cannot enter any more."""
        return int(self.scores[-1]) if len(self.scores) == self.top else self.low


def narrow(block: Columns, vector: np.ndarray, alive: np.ndarray, best: list[Best]) -> None:
    """Add the rows of a block that belong among the best of each window.

    ``alive`` is the bitmap of rows that may take part; it is used up.
    """
    order = np.argsort(-np.abs(vector), kind="stable")
    ends = np.sort(np.stack([vector * block.least, vector * block.most]), axis=0)[:, order]
    # what the columns from a place on can add, at least and at most
    after = np.zeros((2, len(order) + 1), dtype=np.int64)
    after[:, :-1] = ends[:, ::-1].cumsum(axis=1)[:, ::-1]
    score = np.zeros(len(alive), dtype=np.int64)
    rows = np.flatnonzero(alive)
    for at in range(0, max(len(order), 1), STEP):
        read = order[at: at + STEP]
        score[rows] += vector[read] @ block.values[np.ix_(read, rows)]
        rest = after[:, min(at + STEP, len(order))]
        low, high = score[rows] + rest[0], score[rows] + rest[1]
        useful = np.zeros(len(rows), dtype=bool)
        for b in best:
            floor = b.floor
            sure = low[(low >= floor) & (high <= b.high)]
            if len(sure) >= b.top:
                floor = np.partition(sure, len(sure) - b.top)[len(sure) - b.top]
            useful |= (high >= floor) & (low <= b.high)
        alive[rows[~useful]] = False
        rows = np.flatnonzero(alive)
        if not len(rows):
            return
    scores, ids = score[rows], block.ids[rows]
    for b in best:
        inside = (scores >= b.floor) & (scores <= b.high)
        if inside.any():
            b.add(scores[inside], ids[inside])


def scanner(
    anchors: list[Wanted], width: int, top: int, same_label: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best rows of a task for every anchor and window: at most ``top`` each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [[Best(low, high, top) for _, low, high in a.windows] for a in anchors]
        for batch in batches:
            if not batch.num_rows:
                continue
            block = Columns(batch, width)
            for anchor, best in zip(anchors, kept):
                same = block.of_label(anchor.label)
                alive = (same if same_label else ~same) & (block.ids != anchor.id)
                if best:
                    narrow(block, anchor.vector, alive, best)
        found = [
            (a.place, slot, int(i), int(s))
            for a, best in zip(anchors, kept) for (slot, *_), b in zip(a.windows, best)
            for i, s in zip(b.ids, b.scores)
        ]
        if found:
            place, slot, ids, scores = zip(*found)
            yield pa.record_batch(
                [pa.array(place, pa.int64()), pa.array(slot, pa.int32()),
                 pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                names=["place", "slot", "id", "score"],
            )

    return scan


def _rounds(
    rows: DataFrame, anchors: DataFrame, n_anchors: int, width: int, top: int, same_label: bool,
    block: int, windows: DataFrame | None,
) -> DataFrame:
    """The best rows for all anchors, a block of anchors at a time; stored, and read back."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "found")
    spark.createDataFrame([], FOUND).write.parquet(path)
    for at in range(0, n_anchors, block):
        here = lambda df: df.where(F.col("place").between(at + 1, at + block))
        wide: dict[int, list] = {}
        if windows is not None:
            for w in here(windows).toArrow().to_pylist():
                wide.setdefault(w["place"], []).append((w["slot"], w["low"], w["high"]))
        table = here(anchors).toArrow()
        vectors = np.stack(
            [table.column(f"d{d}").to_numpy() for d in range(width)], axis=1
        ) if width else np.zeros((table.num_rows, 0), np.int64)
        wanted = [
            Wanted(place, i, label, vector,
                   ((0, LEAST, MOST),) if windows is None else tuple(wide.get(place, ())))
            for place, i, label, vector in zip(
                table.column("place").to_pylist(), table.column("id").to_pylist(),
                table.column("label").to_pylist(), vectors)
        ]
        found = rows.mapInArrow(scanner(wanted, width, top, same_label), FOUND)
        found.write.mode("append").parquet(path)
    stored = spark.read.schema(FOUND).parquet(path)
    stored._handed_path = path
    return stored


def _first(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks; every task sent ``top`` rows of a window at most."""
    by = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def hard_negatives(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    anchor_every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 5,
    share: tuple[int, int] = (80, 100), block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose key is divisible by ``anchor_every``. A score is the inner product
    of two vectors of ``floor(scale * x)``. An anchor's positives are the best other rows of its
    label; for each of them the best rows of other labels come back whose score is at most the
    positive's and at least ``share[0] / share[1]`` of it. Ties go to the smaller key.

    Rows without key or label, without a vector, or with a component that is null or not finite
    take no part. Shorter vectors count as filled up with 0; an empty one scores 0 with all. Rows
    that repeat a key are rows of their own: each anchor row has its own answer, and every row
    takes a place of its own among the first five. Rows with the key of an anchor are neither its
    positives nor its negatives. No rows, or no anchors, give no rows. Further columns of the
    input are not read. Components so large that scores would leave 64 bits are an error.
    """
    named = rows.select(
        F.col(key).cast("bigint").alias("id"), F.col(label).alias("label"),
        F.col(vector).alias("v"),
    ).where("id IS NOT NULL AND label IS NOT NULL").where(usable("v"))
    width = width_of(named, "v")
    dims = [f"d{d}" for d in range(width)]
    vertical = handed_over(
        named.withColumn("q", whole("v", scale))
        .select("id", "label", *[F.expr(f"coalesce(get(q, {d}), 0)").alias(f"d{d}")
                                 for d in range(width)]),
        "vertical",
    )
    largest = F.array_max(F.array(F.lit(0), *[F.abs(d) for d in dims]))
    check_room(vertical.agg(F.max(largest)).first()[0] or 0, width)
    anchors = handed_over(
        with_position(vertical.where(F.col("id") % anchor_every == 0), ["id"], "place"), "anchors"
    )
    n_anchors = anchors.count()

    near = _rounds(vertical, anchors, n_anchors, width, positives, True, block, None)
    num, den = share
    liked = handed_over(
        _first(near, positives).select(
            "place", F.col("rank").alias("slot"), F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # a negative positive score has no window: its share lies above it
    windows = liked.select(
        "place", "slot", F.col("positive_score").alias("high"),
        F.expr(f"{num} * positive_score div {den} + int({num} * positive_score % {den} > 0)")
        .alias("low"),
    ).where("low <= high")
    far = _rounds(vertical, anchors, n_anchors, width, negatives, False, block, windows)
    release(near, vertical)
    return (
        _first(far, negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(liked, ["place", "slot"])
        .join(anchors.select("place", F.col("id").alias("anchor_id")), "place")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score")
    )


travels(__name__)
