"""Matches as a graph: components, one-to-one assignment, bridges between sources. [GR1-GR6, J11-J13, SL1]"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text as T
from kindred.operators import keys as K
from kindred.sources import scratch


def _checkpointed(df: DataFrame) -> DataFrame:
    """Cuts lineage in the folder of spark.checkpoint.dir, so that no executor's loss undoes a round."""
    return scratch.materialize(df, "graph")


#: Edges that one task contracts at once.
TASK_EDGES = 1_000_000


def _contracted(pairs: DataFrame, tasks: int) -> DataFrame:
    """Within each task every node is linked to the least node connected with it, and to nothing else."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        df = pd.concat(frames)
        nodes, at = np.unique(np.concatenate([df["u"].to_numpy(), df["v"].to_numpy()]), return_inverse=True)
        i, j, label = at[: len(df)], at[len(df) :], np.arange(len(nodes))
        while True:
            new, low = label.copy(), np.minimum(label[i], label[j])
            for ends in (label[i], label[j], i, j):
                np.minimum.at(new, ends, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        other = label != np.arange(len(nodes))
        yield pd.DataFrame({"u": nodes[other], "v": nodes[label[other]]})

    kind = dict(pairs.dtypes)["u"]
    return pairs.coalesce(tasks).mapInPandas(run, f"u {kind}, v {kind}")


def components(edges: DataFrame, rounds: int = 60, task_edges: int = TASK_EDGES) -> DataFrame:
    """node, component (the least node reachable). [GR1]

    A graph of at most task_edges edges is contracted by one task; beyond, each round contracts within tasks and takes a
    large-star and a small-star step between them.
    """
    pairs = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs, before = _checkpointed(pairs), None
    for _ in range(rounds):
        tasks = -(-pairs.count() // task_edges)
        if not tasks:
            break
        pairs = _checkpointed(_contracted(pairs, tasks))
        if tasks == 1:
            break
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = _checkpointed(small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") / 2.0**40), F.max("u")).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    heads = pairs.select("v", F.col("v").alias("c")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)


def greedy(edges: list[tuple[str, str, float]]) -> dict[str, dict[str, str]]:
    """{s1: {source: target}} of edges in order: an S1 takes at most one record of each other source and a record goes
    to one S1. An edge between S2 and S3 hands a free record to the S1 that has the other; a second pass over these
    edges makes that independent of where in the order they stand. [GR2, GR3]"""
    slots: dict[str, dict[str, str]] = {}
    owner: dict[str, str] = {}

    def give(s1: str, target: str) -> None:
        mine = slots.setdefault(s1, {})
        if target not in owner and target[:2] not in mine:
            mine[target[:2]], owner[target] = target, s1

    def bridge(u: str, v: str) -> None:
        two, three = sorted((u, v))
        if two in owner:
            give(owner[two], three)
        elif three in owner:
            give(owner[three], two)

    for u, v, _ in edges:
        ends = {u[:2]: u, v[:2]: v}
        if len(ends) == 2:
            if "S1" in ends:
                give(ends.pop("S1"), next(iter(ends.values())))
            else:
                bridge(u, v)
    for u, v, _ in edges:
        if {u[:2], v[:2]} == {"S2", "S3"}:
            bridge(u, v)
    return {s1: mine for s1, mine in slots.items() if mine}


def assign(edges: DataFrame, least: float = 0.70) -> DataFrame:
    """s1_id, s2_id, s3_id for each S1 that gets a match. edges: u, v, w, and edge_type for ties if there is one.

    Edges are taken by falling weight, ties by (edge_type, u, v). Decisions never cross a component, so each is solved
    by itself.
    """
    strong = edges.filter(F.col("w") >= least)
    if "edge_type" not in edges.columns:
        strong = strong.withColumn("edge_type", F.lit(""))
    labels = components(strong.select("u", "v"))
    rows = strong.join(labels, strong["u"] == labels["node"]).select("u", "v", "w", "edge_type", "component")

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["w", "edge_type", "u", "v"], ascending=[False, True, True, True])
        found = greedy(list(zip(group["u"], group["v"], group["w"], strict=True)))
        out = [(s1, mine.get("S2"), mine.get("S3")) for s1, mine in found.items()]
        return pd.DataFrame(out, columns=["s1_id", "s2_id", "s3_id"])

    return rows.groupBy("component").applyInPandas(solve, "s1_id string, s2_id string, s3_id string")


def assembled(assigned: DataFrame) -> DataFrame:
    """[GR4]"""
    return assigned.select("s1_id", F.array_compact(F.array("s2_id", "s3_id")).alias("matched"))


def bridge_edges(two: DataFrame, three: DataFrame, weight: float = 0.95, most: int | None = 3) -> DataFrame:
    """Edges (u, v, w) between S2 and S3 records of one country and name, of each name the first S2 records. [J11]"""
    key = K.key_of(F.lower(K.country_of()), T.clean_name("name"))
    left = two.select(F.col("entity_id").alias("u"), "ord", key.alias("key"))
    if most is not None:
        w = Window.partitionBy("key").orderBy("ord", "u")
        left = left.filter(F.col("key").isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most)
    right = three.select(F.col("entity_id").alias("v"), key.alias("key"))
    return left.join(right, "key").select("u", "v", F.lit(weight).alias("w"))


def address_agrees(a: Column, b: Column) -> Column:
    """At least two words in common, or at most two words each. [J12]"""
    return (F.size(F.array_intersect(a, b)) >= 2) | ((F.size(a) <= 2) & (F.size(b) <= 2))


def transitive(matches: DataFrame, records: DataFrame, check_address: bool = True) -> DataFrame:
    """matches (s1_id, s2_id, s3_id) with an empty slot filled by the first record, in read order, of the other source
    that has the country and name of the match there is, and agrees in address. One hop, both directions. [GR5, J12, J13]
    """
    words = F.array_distinct(F.filter(F.split(F.lower(T.present("address")), r"\s+"), lambda t: t != ""))
    key = K.key_of(F.lower(K.country_of()), T.clean_name("name"))
    known = records.select("entity_id", "ord", key.alias("key"), words.alias("words"))
    known = known.withColumn("source", F.substring("entity_id", 1, 2)).filter(F.col("key").isNotNull())
    has = F.coalesce("s2_id", "s3_id")
    half = matches.filter(F.col("s2_id").isNull() != F.col("s3_id").isNull()).withColumn("has", has)
    near = known.select(F.col("entity_id").alias("has"), "key", F.col("words").alias("own"), F.col("source").alias("from"))
    far = known.select(F.col("entity_id").alias("other"), "ord", "key", "words", "source")
    pairs = half.join(near, "has").join(far, "key").filter("source <> from and source <> 'S1'")
    if check_address:
        pairs = pairs.filter(address_agrees(F.col("own"), F.col("words")))
    first = pairs.groupBy("s1_id").agg(F.min_by("other", F.struct("ord", "other")).alias("new"))
    rows = matches.join(first, "s1_id", "left")
    slot = lambda c, s: F.coalesce(F.col(c), F.when(F.col("new").startswith(s), F.col("new"))).alias(c)
    return rows.select("s1_id", slot("s2_id", "S2"), slot("s3_id", "S3"))
