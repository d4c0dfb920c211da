"""Connected components of links, by alternating stars over locally contracted edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import handed_over, release
from .shared import travels

travels(__name__)

#: Edges that a task contracts at a time, which bounds its memory.
CHUNK = 2**20


def roots_of(u: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """Smallest node that each of the nodes 0 to size - 1 reaches."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], least)
        np.minimum.at(root, root[v], least)
        while (root[root] != root).any():
            root = root[root]
        if (root[u] == root[v]).all():
            return root


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components, where each task hangs the nodes of its own edges on
    the smallest that they reach by them. Nothing is shuffled."""
    def stars(chunk: pa.Table) -> pa.RecordBatch:
        ends = pa.chunked_array([*chunk.column("u").chunks, *chunk.column("v").chunks])
        nodes = pc.unique(ends)
        nodes = nodes.take(pc.sort_indices(nodes))
        at = pc.index_in(ends, nodes).to_numpy(zero_copy_only=False)
        root = roots_of(at[:chunk.num_rows], at[chunk.num_rows:], len(nodes))
        below = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays(
            [nodes.take(pa.array(below)), nodes.take(pa.array(root[below]))], names=["u", "v"]
        )

    def contract(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield stars(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield stars(pa.Table.from_batches(held))

    return edges.mapInArrow(contract, edges.schema)


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Connect every neighbour on one side of a node with the node's smallest neighbour.

    The smallest neighbour comes from an aggregate that is stored before it is joined, so AQE may
    split the edges of a node that has very many.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = handed_over(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    met = both.join(least, "u")
    if large:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    found = handed_over(moved.where("u <> v").distinct(), "stars")
    release(least)
    return found


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on a node that hangs on none."""
    roots = edges.select(F.col("v").alias("u")).distinct()
    twice = edges.groupBy("u").count().where("count > 1").select("u")
    deep = edges.join(roots, "u", "left_semi").select("u")
    return twice.unionByName(deep).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Node and smallest node that it reaches, for every node that has a link.

    Each round of stars brings every node nearer to the smallest of its component, whatever the
    width of the tree. Tasks contract their own edges before the first round and after each one.
    """
    edges = handed_over(
        _contracted(
            links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where("u <> v").distinct()
        ),
        "links",
    )
    while not _settled(edges):
        wide = _stars(edges, large=True)
        narrow = _stars(wide, large=False)
        shorter = handed_over(_contracted(narrow).distinct(), "shorter")
        release(edges, wide, narrow)
        edges = shorter
    # every node now hangs on the smallest of its component
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
