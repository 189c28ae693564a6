"""Connected components of a large edge list, by alternating star contractions.

Each round rewires every node's larger neighbours to its smallest one (large star),
then its smaller ones (small star), until only stars remain. The state is an edge
table in the shared scratch folder; nothing but row counts comes to the driver. Rounds
grow with the logarithm of the longest path.

A round is several shuffles however few edges are left, so before each one the edges are
contracted without any: a chunk of at most about ``CHUNK_EDGES`` edges becomes stars around
the smallest nodes it connects. Chunks are bounded and their number follows the edges. No
node's smallest neighbour gets larger by that, so the rounds still end. Whether stars remain
is seen while the smallest neighbours are written, which the next round needs anyway.

The centre of a large group has an edge per member. Its edges are joined with one row of
its own, from a stored table: both sides are then plain shuffles, and a partition with a
centre's edges is split over tasks at run time (as adaptive execution does for skewed
joins; it cannot where the other side is an aggregate of the same shuffle).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from touchtrail.llm.common import Batches, stored, stored_with, table_batch

CHUNK_EDGES = 1 << 18


def _stored_edges(edges: DataFrame) -> tuple[DataFrame, int]:
    table, seen = stored_with(edges, "component-edges", F.count(F.lit(1)).alias("n"))
    return table, seen["n"]


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest one that the edges (u, v) connect it with."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root[root], root):
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _contracted(table: DataFrame, n: int, chunk: int) -> DataFrame:
    """The ``n`` edges with those of each chunk as stars; other nodes than longs stay as they are."""
    if any(f.dataType != LongType() for f in table.schema):
        return table
    schema = pa.schema([pa.field("u", pa.int64()), pa.field("v", pa.int64())])

    def star_batch(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in "uv")
        return table_batch(schema, dict(zip("uv", stars(u, v))))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(h.num_rows for h in held) >= chunk:
                yield star_batch(held)
                held = []
        if held:
            yield star_batch(held)

    return stored(table.coalesce(-(-n // chunk)).mapInArrow(run, "u long, v long"), "component-chunks")


def _smallest(edges: DataFrame) -> tuple[DataFrame, int]:
    """(u, m): the smallest neighbour of each node, counted before the shuffle.

    Also the number of nodes that are neither a centre, below all their neighbours, nor a
    leaf, with a smaller neighbour only: where ``edges`` are in both directions and none are
    left, the edges are stars.
    """
    smallest, largest = F.min("v"), F.max("v")
    table, seen = stored_with(
        edges.groupBy("u").agg(
            smallest.alias("m"),
            ((smallest < F.col("u")) & (smallest < largest)).alias("between"),
        ),
        "component-centres",
        F.count_if("between").alias("n"),
    )
    return table.select("u", "m"), seen["n"]


def components(edges: DataFrame, chunk: int = CHUNK_EDGES) -> DataFrame:
    """(node, component) of every node with an edge; a component is its smallest node.

    ``edges`` has two columns of nodes of one orderable type, in either order; repeated
    edges and loops are allowed, NULL ends are not. No edges: no rows.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    oriented = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct()
    )
    table, n = _stored_edges(oriented)  # u > v throughout
    if not n:
        return table.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        table = _contracted(table, n, chunk)
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        centres, between = _smallest(both)
        if not between:
            return centres.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        large = (
            both.join(centres, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = stored(large, "component-stars")
        small = (
            large.join(_smallest(large)[0], "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        table, n = _stored_edges(small)
