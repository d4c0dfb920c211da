"""CSV whose quoted texts hold line breaks, read in many tasks.

Whether a line starts inside quotes depends on all quotes before it. A first pass counts the
quotes of every split of a file; summed in order of the splits, their parity says how each split
starts. A second pass then cuts every split into records on its own. A record that runs over the
end of a split leaves a piece in each, and those pieces, two per split at most, are put together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

QUOTE = '"'
#: How a piece of text lies in its split.
WHOLE, HEAD, TAIL = 0, 1, 2
PIECES = "file string, start long, kind int, header boolean, record string"
#: Rows sent on at a time.
BATCH = 5000


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they lie in the file, each with the split it was read in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def split_parities(found: DataFrame) -> DataFrame:
    """file, start, inside (whether the split starts inside quotes), open (whether it ends so)."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = found.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    # one row per split of a file
    upto = Window.partitionBy("file").orderBy("start")
    before = F.coalesce(F.sum("odd").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.select(
        "file", "start", (before % 2 == 1).alias("inside"),
        ((before + F.col("odd")) % 2 == 1).alias("open"),
    )


class Cutter:
    """The records of one split, fed line by line."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.kind, self.pending = (HEAD if inside else WHOLE), []
        self.first = not inside and start == 0

    def line(self, text: str) -> tuple | None:
        """Take a line; a piece comes back if it ends there."""
        self.pending.append(text)
        if text.count(QUOTE) % 2:
            self.inside = not self.inside
        if self.inside:
            return None
        return self._piece(self.kind)

    def rest(self) -> tuple | None:
        """What the end of the split cut off."""
        return self._piece(self.kind or TAIL) if self.pending else None

    def _piece(self, kind: int) -> tuple:
        piece = (self.file, self.start, kind, self.first, "\n".join(self.pending))
        self.kind, self.pending, self.first = WHOLE, [], False
        return piece


def cutting(
    inside: dict[tuple[str, int], bool], wanted: Callable[[int], bool]
) -> Callable[[Iterator], Iterator]:
    """Pieces of the wanted kinds from lines that come split by split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, out = None, []
        for batch in batches:
            plain = cutter is not None and not cutter.pending and _one_line_each(batch, cutter)
            if plain:  # what a line-by-line reading would find, too
                if wanted(WHOLE):
                    if out:
                        yield _pieces(out)
                        out = []
                    yield _whole(batch)
                continue
            for text, file, start in zip(*(c.to_pylist() for c in batch.columns)):
                if cutter is None or (cutter.file, cutter.start) != (file, start):
                    if cutter is not None:
                        out.append(cutter.rest())
                    # an unknown split would mean that the passes were split differently
                    cutter = Cutter(file, start, inside[file, start])
                out.append(cutter.line(text))
            out = [p for p in out if p is not None and wanted(p[2])]
            if len(out) >= BATCH:
                yield _pieces(out)
                out = []
        if cutter is not None:
            out = [p for p in [*out, cutter.rest()] if p is not None and wanted(p[2])]
        if out:
            yield _pieces(out)

    return run


def _one_line_each(batch: pa.RecordBatch, cutter: Cutter) -> bool:
    """Whether every line is a record: all of the cutter's split, no quote left open."""
    if cutter.inside or cutter.first or not batch.num_rows:
        return False
    text, file, start = batch.columns
    return (
        pc.all(pc.equal(start, cutter.start)).as_py() and pc.all(pc.equal(file, cutter.file)).as_py()
        and not pc.any(pc.equal(pc.bit_wise_and(pc.count_substring(text, QUOTE), 1), 1)).as_py()
    )


def _whole(batch: pa.RecordBatch) -> pa.RecordBatch:
    text, file, start = batch.columns
    n = batch.num_rows
    return pa.record_batch(
        [file.cast(pa.string()), start, pa.array([WHOLE] * n, pa.int32()), pa.array([False] * n),
         text.cast(pa.string())],
        names=["file", "start", "kind", "header", "record"],
    )


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)]
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(columns, types)],
        names=["file", "start", "kind", "header", "record"],
    )


def _without_return(found: DataFrame) -> DataFrame:
    return found.withColumn("record", F.regexp_replace("record", r"\r$", ""))


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, header, record: the logical lines of all files, ``header`` for each file's first.

    The driver keeps one flag per split, a few bytes for every 128 MB of input. A file whose
    quotes do not pair is an error: nothing says where its records end.
    """
    found = lines(spark, path)
    inside, unpaired, cut = {}, {}, []
    for r in split_parities(found).orderBy("file", "start").toLocalIterator():
        inside[r.file, r.start] = r.inside
        unpaired[r.file] = r.open
        if r.inside or r.open:
            cut.append((r.file, r.start))
    bad = sorted(file for file, odd in unpaired.items() if odd)
    if bad:
        raise ValueError(f"quotes do not pair in {', '.join(bad[:5])}")
    whole = found.mapInArrow(cutting(inside, lambda kind: kind == WHOLE), PIECES)
    whole = whole.select("file", "header", "record")
    if not cut:  # splits that start and end outside quotes hold whole records alone
        return _without_return(whole)
    pieces_in = spark.createDataFrame(pa.table({
        "_file": [file for file, _ in cut], "_start": pa.array([at for _, at in cut], pa.int64()),
    }))
    halved = found.join(
        F.broadcast(pieces_in),
        (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")), "left_semi",
    )
    parts = halved.mapInArrow(cutting(inside, lambda kind: kind != WHOLE), PIECES)
    # at most one head and one tail per split; a tail opens a record, heads go on with it
    opened = F.sum((F.col("kind") == TAIL).cast("int")).over(
        Window.partitionBy("file").orderBy("start", "kind")
    )
    joined = (
        parts.withColumn("_of", opened).groupBy("file", "_of")
        .agg(F.bool_or("header").alias("header"),
             F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("_parts"))
        .select("file", "header", F.array_join("_parts.record", "\n").alias("record"))
    )
    return _without_return(whole.unionByName(joined))


def read(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Rows of all files below a path, header lines left out, typed by the schema.

    The rows are those of Spark's multi-line reader, for files whose quotes only enclose fields
    or are doubled inside them.
    """
    settings = {k: str(v) for k, v in {"quote": QUOTE, "escape": QUOTE, **options}.items()}
    ddl = schema.toDDL()
    rows = records(spark, path).where("NOT header AND record <> ''")
    return rows.select(F.from_csv("record", ddl, settings).alias("r")).select("r.*")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
