"""Connected components by contraction inside tasks and pointer jumping, as joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnwise.session import landed_path, remove_path

# Edges that a task contracts at once.
EDGES_AT_ONCE = 1 << 20


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that it reaches over the links (i, j)."""
    label = np.arange(n)
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            nearer = label[label]
            if (nearer == label).all():
                break
            label = nearer


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a, b) are stars: each node points to one other, which points to none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    roles = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return roles.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges (a, b): edges (a, b) from each node to the smallest one that it reaches, some edges at a time."""
    waiting, size = [], 0

    def done() -> pa.RecordBatch:
        ends = np.concatenate([x for pair in zip(*waiting) for x in pair])
        nodes, which = np.unique(ends, return_inverse=True)
        root = spanning(len(nodes), which[: len(ends) // 2], which[len(ends) // 2:])
        rows = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(nodes[root[rows]])], names=["a", "b"])

    for batch in batches:
        waiting.append([c.to_numpy() for c in batch.columns])
        size += len(batch)
        if size >= EDGES_AT_ONCE:
            yield done()
            waiting, size = [], 0
    if size:
        yield done()


def _gathered(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a the larger, that join the same nodes: all those of one ``a`` are contracted in one task."""
    return edges.repartition("a").mapInArrow(contract, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b) of longs: the smallest node it reaches.

    Tasks contract the edges they hold, first as they are read and then by the larger node; a
    node is left with one edge a task, so none is hot. A round lets each edge end at the smallest
    node that its lower end is linked to, and contracts again. It keeps reachability and at least
    halves the depth to a component's smallest node, so rounds are logarithmic in a component's
    diameter. A round is a grouped minimum, combined before the shuffle, a join of written tables,
    whose size Spark knows and whose hot partitions it may split, and a shuffle by the larger
    node. No component is ever gathered. Self-loops give a node its own label.
    """
    spark = edges.sparkSession
    alone = edges.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("label"))
    now, path = landed_path(spark, _gathered(edges.where("a <> b").select("a", "b").mapInArrow(contract, "a bigint, b bigint")), "graph-edges")
    while not _settled(now):
        least, least_path = landed_path(spark, now.groupBy("a").agg(F.min("b").alias("m")), "graph-low")
        jumped = now.join(least.withColumnRenamed("a", "b"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        now, next_path = landed_path(spark, _gathered(jumped), "graph-edges")
        for used in (path, least_path):
            remove_path(spark, used)
        path = next_path
    # A node's label is the smallest node it reaches, so it is the least of what is said of it.
    said = now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label"))).unionByName(alone)
    return said.groupBy("node").agg(F.min("label").alias("label"))
