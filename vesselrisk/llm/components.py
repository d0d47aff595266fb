"""Connected components of an edge table by alternating star contraction.

Edges are (u, v) with u > v. A large star joins every larger neighbour of a node to the
node's least neighbour; a small star does so with the smaller ones. Both only take
minima (partial sums before the shuffle) and equi-joins that Spark may split when one
node is hot. The steps end with one edge from each node to the least node of its component.

Edges may be contracted within their tasks before (as partial sums go before a shuffle): what a buffer of edges
links becomes one edge from each of its nodes to the least. Few edges are done then; more go on to the stars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

FEW_TASKS = 50
BUFFER = 1 << 17  # edges that a task contracts at once (2 MB)


def least_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the edges' nodes that are not their own least."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, least = place[: len(u)], place[len(u) :], np.arange(len(nodes))
    while len(a):
        x, y = least[a], least[b]
        on = x != y
        a, b, x, y = a[on], b[on], x[on], y[on]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := least[least], least):
            least = up
    on = least != np.arange(len(nodes))
    return nodes[on], nodes[least[on]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) to those of the stars of each buffer."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def star() -> pa.RecordBatch:
        out = least_of(*(np.concatenate(c) for c in zip(*held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["u", "v"])

    n = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BUFFER):
            b = batch.slice(at, BUFFER)
            if held and n + b.num_rows > BUFFER:
                yield star()
                n = 0
            held.append((np.array(b.column(0)), np.array(b.column(1))))
            n += b.num_rows
    if held:
        yield star()


def _large_star(edges: DataFrame, dealt: Callable) -> DataFrame:
    both = dealt(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return dealt(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def _small_star(edges: DataFrame, dealt: Callable) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return dealt(moved.unionByName(least.select("u", F.col("m").alias("v")))).distinct()


def components(edges: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """(node, root): the least node of the component, for all nodes that are not their own root.

    With ``rows_per_task``, edges are contracted in their tasks first; up to ``BUFFER`` edges are left whole to a last task. Of more,
    up to ``FEW_TASKS`` tasks of so many edges are dealt out by ``u``, once a star, so that few edges
    cost few shuffle files; more are left to Spark, which may split a hot node.
    """

    def dealer(n: int) -> Callable:
        if rows_per_task is None or n > FEW_TASKS * rows_per_task:
            return lambda rows: rows
        return lambda rows: rows.repartition(max(1, -(-n // rows_per_task)), "u")

    print_of = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    edges = edges.select("u", "v")
    if rows_per_task is not None:
        edges = written(edges.mapInArrow(_contracted, "u long, v long"), "edges")
        if edges.count() <= BUFFER:
            edges = written(edges.coalesce(1).mapInArrow(_contracted, "u long, v long"), "edges")
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    edges = written(edges.distinct(), "edges")
    before = print_of(edges)
    while before[0]:
        dealt = dealer(before[0])
        edges = written(_small_star(_large_star(edges, dealt), dealt), "edges")
        after = print_of(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
