"""Operator 2, embedding near-duplicates: sorted projection passes.

Each pass orders all vectors lexicographically by concatenated random hashes and compares each with its WINDOW next
ones; pairs at or above the threshold are united across passes. A hash is the side of a random plane through the mean of
the vectors that are sorted, so that a direction common to all doesn't put them all on one side. The number of passes
follows from the number of vectors, so that a pair right at the threshold meets in some window with probability RECALL
where each hash halves the vectors. Where vectors are dense it doesn't: so each pass also measures for each vector how
many leading hashes leave no more than a window. Vectors whose passes don't add up to RECALL are open. As a pair is sure
to be covered if one of its vectors is, only open vectors are compared further with each other: in more rounds of passes,
about their own mean, as long as a round closes half of them, then by pairs of blocks, all with all.

Windows are bounded, classes of near copies are not. So equal vectors are one class beforehand, windows give only what
connects, and links within each component are then counted exactly, block by block, without writing out pairs.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common, components, vectors

THRESHOLD = 0.95
WINDOW = 32
RECALL = 0.999
BITS = 48
SORT_BLOCK, COUNT_BLOCK, PAIR_BLOCK = 4096, 1024, 2048


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold has met: in a pass it does if it agrees on as many leading hashes as
    leave about half a window of vectors; at least 8."""
    agree = 1 - math.acos(threshold) / math.pi
    meets = agree ** max(0.0, math.log2(max(n, 1) / (window / 2)))
    return max(8, math.ceil(math.log(1 - recall) / math.log(1 - min(meets, 0.999))))


def window_links(x: np.ndarray, group: np.ndarray, threshold: float, window: int) -> np.ndarray:
    """For each row the least row it is connected with through pairs at most `window` rows apart in one group."""
    n = len(x)
    left, right = [], []
    for o in range(1, min(window, n - 1) + 1):
        hit = np.flatnonzero((group[:-o] == group[o:]) & (np.einsum("ij,ij->i", x[:-o], x[o:]) >= threshold))
        left.append(hit)
        right.append(hit + o)
    if not left:
        return np.arange(n)
    return components.least_labels(n, np.concatenate(left), np.concatenate(right))


def separating(keys: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """For each of rows sorted by (group, key) the least number of leading hashes that no more than window + 1 rows of
    its group share with it; BITS + 1 if there is none."""
    n, o = len(keys), window + 1
    out = np.zeros(n, np.int64)
    if n <= o:
        return out
    shared = BITS - np.frexp((keys[:-o] ^ keys[o:]).astype(np.float64))[1]
    shared = np.where(group[:-o] == group[o:], shared, -1)
    for i in range(o + 1):
        np.maximum(out[i : n - o + i], shared + 1, out=out[i : n - o + i])
    return out


def coverage(needed: np.ndarray, z: np.ndarray, cut: np.ndarray, threshold: float) -> np.ndarray:
    """-log of the probability that a pass misses a pair at the threshold t, by the hashes on which it must agree and a
    vector's projections z, which planes cut at `cut`: a partner's projection is normal about t z with the deviation
    sqrt(1 - t^2). Planes that cut a dense region separate its vectors and its pairs alike, so the mean over all planes
    would promise too much."""
    grid = np.linspace(-8, 8, 1601)
    below = np.log([max(0.5 * math.erfc(-g / math.sqrt(2)), 1e-300) for g in grid])
    away = (threshold * z - cut) * np.where(z > cut, 1, -1)
    sides = np.interp(away / math.sqrt(max(1 - threshold**2, 1e-12)), grid, below)
    agree = np.hstack([np.zeros((len(z), 1)), np.cumsum(sides, axis=1), np.full((len(z), 1), -np.inf)])
    meets = np.exp(agree[np.arange(len(z)), needed])
    return -np.log1p(-np.minimum(meets, 1 - 1e-9))


def classes_of(table: DataFrame, id_col: str, column: str, d: int) -> tuple[DataFrame, DataFrame]:
    """Members (id_col, key) and classes of equal vectors (key, node: a number of its own, least: its least id, mult:
    members, vec) of the vectors of d components. Two classes may share an id, so ids don't name them."""
    rows = vectors.packed(table, id_col, column, d).withColumn("key", F.sha2("vec", 256))
    found = rows.groupBy("key", "vec").agg(F.min(id_col).alias("least"), F.count("*").alias("mult"))
    found = found.withColumn("node", F.monotonically_increasing_id())
    return rows.select(id_col, "key"), common.materialize(found, "classes")


def mean_of(classes: DataFrame, d: int) -> np.ndarray:
    """The mean of all directions: sums by task, then one row a task comes to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d), 0
        for batch in batches:
            if batch.num_rows:
                total += vectors.unit(vectors.matrix(batch.column(0).to_pylist(), d)).sum(0)
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total), pa.array([n] * d)], names=["i", "s", "n"])

    sums = classes.select("vec").mapInArrow(add, "i int, s double, n long").groupBy("i").agg(F.sum("s"), F.sum("n"))
    return np.array([total / max(n, 1) for _, total, n in sums.orderBy("i").collect()])


def window_round(classes: DataFrame, d: int, threshold: float, window: int, passes: int, seed: int) -> DataFrame:
    """Edges (u, v) between classes that connect whatever some window has found linked, and for each
    vector and pass a row (u: node, v: null, gain: see coverage)."""

    mean = mean_of(classes, d)

    def drawn() -> tuple[np.ndarray, np.ndarray]:
        planes = np.random.default_rng(seed).standard_normal((d, passes * BITS))
        return planes, mean @ planes

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, cuts = drawn()
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vectors.unit(vectors.matrix(batch.column(1).to_pylist(), d))
            keys = ((x @ planes) > cuts).reshape(len(x), passes, BITS) @ weights
            for p in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * len(x), pa.int32()), pa.array(keys[:, p]), batch.column(0)],
                    names=["pass", "hash", "node"],
                )

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            cols = [pa.array([part] * n, pa.int32()), pa.array(np.arange(at, at + n))]
            at += n
            yield pa.RecordBatch.from_arrays([*cols, *batch.columns], names=["part", "i", *batch.schema.names])

    # Ranks are taken of narrow rows; vectors travel once, to the blocks where they are compared.
    keyed = classes.select("node", "vec").mapInArrow(hashed, "pass int, hash long, node long")
    order = ("pass", "hash", "node")
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = common.materialize(ordered.mapInArrow(numbered, "part int, i long, pass int, hash long, node long"), "sorted")
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    base = common.prefix_offsets(sizes, "part", "n", "base").select("part", "base")
    ranked = ordered.join(base, "part").withColumn("rank", F.col("base") + F.col("i"))
    block = F.expr(f"rank div {SORT_BLOCK}")
    # A block has the rows within reach of its own, on both sides.
    reach, at = window + 1, F.col("rank") % SORT_BLOCK
    near = F.array(block, F.when(at < reach, block - 1), F.when(at >= SORT_BLOCK - reach, block + 1))
    dealt = ranked.select("rank", "pass", "hash", "node", F.explode(F.array_compact(near)).alias("block"))
    dealt = dealt.join(classes.select("node", "vec"), "node").select("block", "rank", "pass", "hash", "node", "vec")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank")
        nodes, passes_ = group["node"].to_numpy(), group["pass"].to_numpy()
        x = vectors.unit(vectors.matrix(group["vec"], d))
        label = window_links(x, passes_, threshold, window)
        other = label != np.arange(len(label))
        needed, gain, (planes, cuts) = separating(group["hash"].to_numpy(), passes_, window), np.zeros(len(x)), drawn()
        for p in np.unique(passes_):
            of, bits = passes_ == p, slice(p * BITS, (p + 1) * BITS)
            gain[of] = coverage(needed[of], x[of] @ planes[:, bits], cuts[bits], threshold)
        own = group["rank"].to_numpy() // SORT_BLOCK == group["block"].to_numpy()
        edges = pd.DataFrame({"u": nodes[other], "v": pd.array(nodes[label[other]], "Int64"), "gain": 0.0})
        none = pd.array([None] * int(own.sum()), "Int64")
        return pd.concat([edges, pd.DataFrame({"u": nodes[own], "v": none, "gain": gain[own]})], ignore_index=True)

    return common.materialize(dealt.groupBy("block").applyInPandas(compare, "u long, v long, gain double"), "windows")


def all_links(classes: DataFrame, n: int, d: int, threshold: float) -> DataFrame:
    """Edges (u, v) that connect all that is linked among n classes: pairs of blocks compared in separate tasks."""
    blocks = -(-n // PAIR_BLOCK)
    own = F.pmod(F.xxhash64(F.lit(4), "node"), F.lit(blocks)).cast("int")
    rows = classes.select("node", "vec", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    rows = rows.select(F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "vec")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node").sort_values("node")
        nodes, own_block = group["node"].to_numpy(), group["own"].to_numpy()
        x = vectors.unit(vectors.matrix(group["vec"], d))
        a, b = (np.flatnonzero(own_block == group[c].iloc[0]) for c in ("lo", "hi"))
        label = np.arange(len(nodes))
        for i in range(0, len(a), 256):
            left, right = np.nonzero(x[a[i : i + 256]] @ x[b].T >= threshold)
            if len(left):
                rows_ = np.arange(len(nodes))
                left, right = np.concatenate([rows_, a[left + i]]), np.concatenate([label, b[right]])
                label = components.least_labels(len(nodes), left, right)
        other = label != np.arange(len(label))
        return pd.DataFrame({"u": nodes[other], "v": nodes[label[other]]})

    return rows.groupBy("lo", "hi").applyInPandas(compare, "u long, v long")


def connecting_edges(classes: DataFrame, d: int, threshold: float, window: int, seed: int) -> DataFrame:
    """Edges (u, v) between classes that connect whatever is linked, a pair at the threshold with
    probability RECALL."""
    rows, n, edges, enough = classes.select("node", "vec", F.lit(0.0).alias("had")), classes.count(), None, -math.log(1 - RECALL)
    for i in itertools.count():
        found = window_round(rows, d, threshold, window, passes_for(n, threshold, window), seed + 1000 * i)
        linked = found.filter("v is not null").select("u", "v")
        edges = edges.union(linked) if edges else linked
        gains = found.filter("v is null").groupBy("u").agg(F.sum("gain").alias("gain")).withColumnRenamed("u", "node")
        rows = rows.join(gains, "node").withColumn("had", F.col("had") + F.col("gain")).drop("gain")
        rows = common.materialize(rows.filter(F.col("had") < enough), "open")
        before, n = n, rows.count()
        if n < 2:
            return edges.distinct()
        if n <= PAIR_BLOCK or 2 * n > before:
            return edges.union(all_links(rows, n, d, threshold)).distinct()


def link_counts(classes: DataFrame, labels: DataFrame, d: int, threshold: float) -> DataFrame:
    """node, linked: the vectors of other classes at or above the threshold, of those in the same component.

    A component of more than COUNT_BLOCK classes is dealt to blocks and compared by pairs of blocks in separate tasks.
    """
    members = classes.join(labels, "node").select("node", "mult", "vec", "component")
    members = common.materialize(members, "members")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    blocks = F.expr(f"(n + {COUNT_BLOCK - 1}) div {COUNT_BLOCK}")
    sizes = sizes.select("component", blocks.cast("int").alias("blocks"))
    bins = max(1, -(-members.count() // COUNT_BLOCK))
    own = F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")).cast("int")
    rows = members.join(sizes, "component").withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Components of one block share tasks; larger ones have a task for each pair of blocks.
    small = F.pmod(F.xxhash64(F.lit(3), "component"), F.lit(bins))
    rows = rows.withColumns(
        {
            "bin": F.when(F.col("blocks") > 1, F.col("component")).otherwise(-1 - small),
            "lo": F.least("own", "other"),
            "hi": F.greatest("own", "other"),
        }
    )

    def count(group: pd.DataFrame) -> pd.DataFrame:
        nodes, totals = [], []
        for _, c in group.groupby("component", sort=True):
            c = c.drop_duplicates("node").sort_values("node")
            x, mult, own_block = vectors.unit(vectors.matrix(c["vec"], d)), c["mult"].to_numpy(), c["own"].to_numpy()
            lo, hi = int(c["lo"].iloc[0]), int(c["hi"].iloc[0])
            a, b = np.flatnonzero(own_block == lo), np.flatnonzero(own_block == hi)
            if not len(a) or not len(b):
                continue
            linked = (x[a] @ x[b].T) >= threshold
            if lo == hi:
                np.fill_diagonal(linked, False)
            nodes.append(c["node"].to_numpy()[a])
            totals.append(linked @ mult[b])
            if lo != hi:
                nodes.append(c["node"].to_numpy()[b])
                totals.append(linked.T @ mult[a])
        empty = np.empty(0, np.int64)
        return pd.DataFrame({"node": np.concatenate([empty, *nodes]), "linked": np.concatenate([empty, *totals])})

    counted = rows.select("bin", "lo", "hi", "component", "node", "mult", "own", "vec")
    counted = counted.groupBy("bin", "lo", "hi").applyInPandas(count, "node long, linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def dedup_length(
    table: DataFrame, id_col: str, column: str, d: int, threshold: float, window: int, seed: int
) -> DataFrame:
    """id_col, n_links and component_id of each vector of d components that takes part."""
    members, classes = classes_of(table, id_col, column, d)
    edges = connecting_edges(classes, d, threshold, window, seed)
    labels = common.materialize(components.connected_components(edges), "labels")
    counts = link_counts(classes, labels, d, threshold)
    found = classes.join(labels, "node", "left").join(counts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Nodes are in no order of ids: a component is named by the least id of its classes.
    named = found.groupBy("component").agg(F.min("least").alias("component_id"))
    n_links = (F.col("mult") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    found = found.join(named, "component").select("key", n_links, "component_id")
    return members.join(found, "key").select(id_col, "n_links", "component_id")


def dedup(
    table: DataFrame,
    id_col: str = "vec_id",
    column: str = "embedding",
    threshold: float = THRESHOLD,
    window: int = WINDOW,
    seed: int = 2,
) -> DataFrame:
    """One row for each row of table: id_col, n_links, component_id, kept.

    n_links counts the other rows linked directly (equal vectors are linked), component_id is the least id reachable
    by links. Vectors link with vectors of the same length only; those that can't take part (see vectors.packed) link
    with nothing: 0 links, themselves as component, kept. Each row is a vector of its own: rows that repeat an id and its
    vector link with each other like any equal vectors, rows that repeat an id with another vector don't. A null id is
    kept and has a null component.
    """
    lengths = [d for d, m in sorted(vectors.lengths(table, column).items()) if m > 1]
    linked = [dedup_length(table, id_col, column, d, threshold, window, seed) for d in lengths]
    if linked:
        linked = common.materialize(functools.reduce(DataFrame.unionByName, linked), "linked")
    else:
        linked = table.sparkSession.createDataFrame([], f"{id_col} long, n_links long, component_id long")
    ids = table.select(F.col(id_col).cast("long"))
    # Rows that take no part are what is left of each id.
    rest = ids.groupBy(id_col).agg(F.count("*").alias("_all")).join(
        linked.groupBy(id_col).agg(F.count("*").alias("_in")), id_col, "left"
    ).withColumn("_n", F.col("_all") - F.coalesce("_in", F.lit(0))).filter("_n > 0")
    rest = rest.select(
        id_col, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")
    ).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    kept = F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    return linked.unionByName(rest).withColumn("kept", kept)
