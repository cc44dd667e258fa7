"""Evidence between classes of records of which only each S1 class's best targets leave a task. [J1-J3, W3]

A record has at most one key of each kind, so a class is a row of key hashes, and two classes share the keys whose hashes
are equal: whoever has both rows has all their evidence. Rows of one key meet in a cell, and a pair belongs to the cell of
the first kind of key that it shares, so it is met in several cells but counted in one, with no list of all hits to group.
Of each cell the best `most` targets of an S1 class are kept; the best `most` of all are among those of its cells.

Rows of one key are dealt to cells of about SHARE by BLOCK classes, and cells to bins; no key is capped here. Hashes have
64 bits: of a hundred million keys two of one kind are taken for one with a probability of about one in four thousand.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators import blocking, ranking
from kindred.operators import keys as K

SHARE, BLOCK = 512, 4096
#: Rows a bin is meant to hold, and pairs that are compared at once.
ROWS, PAIRS = 1 << 15, 1 << 19


def key_hashes(records: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """entity_id, ord and for each key its hash, null where a record has none."""
    made = K.staged(records).select("entity_id", "ord", *[K.KEYS[n].build().alias(n) for n in names])
    return made.select("entity_id", "ord", *[F.when(F.col(n).isNotNull(), F.xxhash64(n)).alias(n) for n in names])


def capped(rows: DataFrame, names: tuple[str, ...], caps: dict[str, int]) -> DataFrame:
    """blocking.capped for key_hashes: entity_id and its hashes, null where a key's first postings leave it out."""
    bound = [n for n in names if n in caps]
    null = F.lit(None).cast("long")
    if not bound:
        return rows.drop("ord")
    made = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n).alias("key")) for n in bound])
    postings = rows.select("entity_id", "ord", F.explode(made).alias("k")).select("entity_id", "ord", "k.kind", "k.key")
    w = Window.partitionBy("kind", "key").orderBy("ord", "entity_id")
    ranked = postings.filter("key is not null").withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max(caps.values()))
    cap = F.coalesce(*[F.when(F.col("kind") == n, F.lit(caps[n])) for n in bound])
    within = ranked.filter(F.col("_rn") <= cap)
    within = within.select("entity_id", *[(F.when(F.col("kind") == n, F.col("key")) if n in bound else null).alias(n) for n in names])
    free = rows.select("entity_id", *[(null if n in bound else F.col(n)).alias(n) for n in names])
    return free.unionByName(within).groupBy("entity_id").agg(*[F.max(n).alias(n) for n in names])


def alike(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """blocking.alike for hashes: entity_id, class, hashes (0: none)."""
    rows = rows.filter(F.coalesce(*names).isNotNull()).fillna(0, list(names))
    return rows.join(rows.groupBy(*names).agg(F.min("entity_id").alias("class")), list(names)).select("entity_id", "class", *names)


def places(names: tuple[str, ...], config: ranking.RankingConfig) -> tuple[np.ndarray, np.ndarray]:
    """For each set of shared keys, as bits in order of names: the bits of its flags, and its place by score and count."""
    flags = [K.KEYS[n].flag for n in names]
    of = [{flags[i] for i in range(len(names)) if bits >> i & 1 and flags[i]} for bits in range(1 << len(names))]
    order = []
    for own in of:
        total = 0.0
        for flag, weight in config.weights.items():
            total += (flag in own) * weight
        order.append((-(total + max(len(own) - 1, 0) * max(config.bonus, 0)), -len(own)))
    place = {x: i for i, x in enumerate(sorted(set(order)))}
    bits = [sum(1 << blocking.FLAGS.index(f) for f in own) for own in of]
    return np.array(bits, np.int32), np.array([place[x] for x in order], np.int64)


def best_of_bin(left: pa.Table, right: pa.Table, names: tuple[str, ...], bits: np.ndarray, place: np.ndarray, most: int) -> pa.Table:
    """s1_class, target_class, _bits of the best `most` targets of each row of left, of the pairs that belong to its cell."""
    left, right = left.sort_by("cell"), right.sort_by("cell")
    cell = right["cell"].to_numpy()
    lo, hi = (np.searchsorted(cell, left["cell"].to_numpy(), side=s) for s in ("left", "right"))
    meets = np.flatnonzero(hi > lo)
    upto = np.concatenate([[0], np.cumsum((hi - lo)[meets])])
    # No kind that neither side has is equal: none is 0 on one side and 1 on the other.
    x = [left[n].to_numpy() for n in names]
    y = [np.where(h == 0, 1, h) for h in (right[n].to_numpy() for n in names)]
    kind = left["kind"].to_numpy().astype(np.int64)
    by_id = pc.sort_indices(right["target_class"]).to_numpy().astype(np.int64)
    rank = np.empty_like(by_id)
    rank[by_id] = np.arange(len(by_id))
    found, start = [], 0
    while start < len(meets):
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + PAIRS, side="right")) - 1)
        own, counts = meets[start:end], np.diff(upto[start : end + 1])
        i = np.repeat(np.arange(len(own)), counts)
        j = np.arange(upto[end] - upto[start]) + np.repeat(lo[own] - (upto[start:end] - upto[start]), counts)
        shared = np.zeros(len(i), np.int64)
        for at in range(len(names)):
            shared |= (x[at][own][i] == y[at][j]).astype(np.int64) << at
        first = (shared & -shared) == (1 << kind[own])[i]
        i, j, shared = i[first], j[first], shared[first]
        # One number orders a row's pairs: its place in the chunk, that of the evidence, that of the target's id.
        order = np.sort(i << 40 | place[shared] << 32 | rank[j])
        s = order >> 40
        nth = np.arange(len(s)) - np.searchsorted(s, np.arange(len(own)))[s]
        found.append((own[s[nth < most]], order[nth < most] & 0xFFFFFFFF))
        start = end
    empty = np.empty(0, np.int64)
    rows, rest = (np.concatenate([empty, *(f[k] for f in found)]) for k in (0, 1))
    cols = by_id[rest]
    shared = sum(((x[at][rows] == y[at][cols]).astype(np.int64) << at for at in range(len(names))), np.zeros(len(rows), np.int64))
    return pa.table({"s1_class": left["s1_class"].take(rows), "target_class": right["target_class"].take(cols), "_bits": pa.array(bits[shared])})


def cells_of(rows: DataFrame, names: tuple[str, ...], *own: str) -> DataFrame:
    """Of each row one for each key: its own columns, its hashes, kind, key."""
    made = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(n).alias("key")) for i, n in enumerate(names)])
    rows = rows.select(*own, *names, F.explode(made).alias("k"))
    return rows.select(*own, *names, "k.kind", "k.key").filter("key <> 0")


def _large(rows: DataFrame, size: int, out: str) -> DataFrame:
    """kind, key and how many parts, of keys that need several: at most one for each `size` rows, so few."""
    counts = rows.groupBy("kind", "key").agg(F.count("*").alias("n")).filter(F.col("n") > size)
    return F.broadcast(counts.select("kind", "key", F.expr(f"(n + {size - 1}) div {size}").alias(out)))


def dealt(left: DataFrame, right: DataFrame, one: tuple[str, ...], two: tuple[str, ...], names: tuple[str, ...], bins: int) -> tuple[DataFrame, DataFrame]:
    """Rows of cells_of with cell and bin: in one of the key's own parts, and in each of the other side's. one and two are
    the sides' own columns; the first deals rows to parts."""
    shares, blocks = _large(left, SHARE, "shares"), _large(right, BLOCK, "blocks")

    def deal(rows: DataFrame, columns: tuple[str, ...], own: str, other: str) -> DataFrame:
        rows = rows.join(shares, ["kind", "key"], "left").join(blocks, ["kind", "key"], "left").fillna(1, ["shares", "blocks"])
        rows = rows.withColumn(f"_{own}", F.pmod(F.xxhash64(columns[0]), F.col(own)))
        rows = rows.withColumn(f"_{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        rows = rows.withColumn("cell", F.xxhash64("kind", "key", "_shares", "_blocks"))
        return rows.select(F.pmod("cell", F.lit(bins)).alias("bin"), "cell", "kind", *columns, *names)

    return deal(left, one, "shares", "blocks"), deal(right, two, "blocks", "shares")


def classes(
    probes: DataFrame,
    targets: DataFrame,
    config: ranking.RankingConfig = ranking.PRODUCTION,
    names: tuple[str, ...] = K.PRODUCTION,
    caps: dict[str, int] | None = None,
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows,
) -> blocking.Classes:
    """blocking.classes with of each S1 class's pairs at least the best `most` by config: for ranking.rank_classes.

    Records that repeat an id may have several keys of a kind; with such ones evidence is listed in full.
    """
    limits = {n: K.KEYS[n].cap for n in names if K.KEYS[n].cap} if caps is None else caps
    hashes = [keep(f"keys-{side}", key_hashes(rows, names)) for side, rows in (("s1", probes), ("target", targets))]
    sizes = [rows.agg(F.count("*"), F.countDistinct("entity_id")).first() for rows in hashes]
    if config.most <= 0 or any(n != ids for n, ids in sizes):
        return blocking.classes(probes, targets, names, limits, keep)
    one, two = (
        keep(f"alike-{side}", alike(capped(rows, names, limits if side == "target" else {}), names))
        for side, rows in zip(("s1", "target"), hashes, strict=True)
    )
    heads = (df.filter("entity_id = class").withColumnRenamed("class", c) for df, c in ((one, "s1_class"), (two, "target_class")))
    left, right = (cells_of(df, names, c) for df, c in zip(heads, ("s1_class", "target_class"), strict=True))
    bins = 1 + sum(n for n, _ in sizes) * len(names) // ROWS
    left, right = dealt(left, right, ("s1_class",), ("target_class",), names, bins)
    bits, place = places(names, config)
    meeting = left.groupBy("bin").cogroup(right.groupBy("bin"))
    most = config.most

    def best(x: pa.Table, y: pa.Table) -> pa.Table:
        return best_of_bin(x, y, names, bits, place, most)

    pairs = blocking.flagged(meeting.applyInArrow(best, "s1_class string, target_class string, _bits int"))
    members = [df.select(F.col("class").alias(f"{s}_class"), F.col("entity_id").alias(f"{s}_id")) for s, df in (("s1", one), ("target", two))]
    return blocking.Classes(pairs, *members)
