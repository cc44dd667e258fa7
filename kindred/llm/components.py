"""Connected components: edges are contracted within tasks of bounded size, what is left between them by alternating
large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common

#: Edges that a task contracts at once: 16 bytes each and about as much again several times over.
TASK_EDGES = 1_000_000


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node connected with it by edges (i, j)."""
    label = np.arange(n)
    while True:
        new, low = label.copy(), np.minimum(label[i], label[j])
        for at in (label[i], label[j], i, j):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _contracted(pairs: DataFrame, tasks: int) -> DataFrame:
    """Within each task every node is linked to the least node connected with it, and to nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            u, v = (np.concatenate(c) for c in zip(*parts, strict=True))
            nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            label = least_labels(len(nodes), at[: len(u)], at[len(u) :])
            other = label != np.arange(len(nodes))
            cols = [pa.array(nodes[other]), pa.array(nodes[label[other]])]
            yield pa.RecordBatch.from_arrays(cols, names=["u", "v"])

    return pairs.coalesce(tasks).mapInArrow(run, "u long, v long")


def _stars(pairs: DataFrame) -> DataFrame:
    """A large-star and a small-star step over edges u > v: the higher neighbours of each node are linked to the least of
    its neighbours and itself; then its lower neighbours, and it, to the least of them."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, rounds: int = 50, task_edges: int = TASK_EDGES) -> DataFrame:
    """node, component (the least node reachable) for each node of edges (u, v: long); loops and nulls are left out.

    A graph of at most task_edges edges is contracted by one task. Beyond, each round contracts within tasks and takes
    both star steps between them, pre-aggregated minimums and joins that adaptive execution can split where a node has
    many neighbours; each round is written to the shared folder.
    """
    pairs = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs, before = common.materialize(pairs, "edges"), None
    for _ in range(rounds):
        tasks = -(-pairs.count() // task_edges)
        if not tasks:
            break
        pairs = common.materialize(_contracted(pairs, tasks), "edges")
        if tasks == 1:
            break
        pairs = common.materialize(_stars(pairs), "edges")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") / 2.0**40), F.max("u")).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select("v", F.col("v").alias("c")).distinct()
    )
