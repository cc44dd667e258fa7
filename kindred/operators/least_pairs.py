"""Negatives drawn from evidence with no list of all its pairs. [SL8]

Of each S1 the pairs with the least digests are drawn. Records of one key meet in cells, as in best_pairs, and each pair
counts in the cell of the first kind of key that it shares; there its digest is computed and an S1's least pairs are kept,
as many as it may need if all its positives are among them. All pairs are looked at, few leave a task.

A digest is the md5 of a short text, computed for many pairs at once on numpy arrays: hashlib takes several times as long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators import best_pairs, blocking, sampling
from kindred.operators import keys as K

#: Pairs whose digests are computed at once: what fits a core's cache.
CHUNK = 1 << 13
#: Bytes of a text that one block of md5 takes.
ONE_BLOCK = 55
_SHIFTS = [s for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in row * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def first_word(words: list[np.ndarray | int], n: int) -> np.ndarray:
    """The first 32 bits, read as hexadecimal digits are, of the md5 of n blocks: words are its sixteen 32-bit numbers."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    # The last change to a is that of step 60.
    for i in range(61):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
            g = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
            g = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
            g = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
            g = 7 * i % 16
        np.add(f, a, out=f)
        if isinstance(words[g], np.ndarray):
            np.add(f, words[g], out=f)
            np.add(f, np.uint32(_SINES[i]), out=f)
        else:
            np.add(f, np.uint32(_SINES[i] + words[g] & 0xFFFFFFFF), out=f)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=t)
        np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        np.bitwise_or(f, t, out=f)
        np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    # Steps 61 to 63 change d, c and b alone; after step 60 the new number stands in b.
    return (b + np.uint32(_START[0])).byteswap()


class Digests:
    """sampling.digest of left id | right id, for pairs of places in two lists of ids."""

    def __init__(self, left: list[str], right: list[str], seed: int):
        self.left = [f"{seed}:{x}|".encode() for x in left]
        self.right = [x.encode() for x in right]
        self.sizes = np.array([len(x) for x in self.left], np.int64)
        self.lengths = np.array([len(x) for x in self.right], np.int64)
        self.blocks: dict[int, np.ndarray] = {}
        width = max(self.sizes, default=0)
        self.short = width + max(self.lengths, default=0) <= ONE_BLOCK
        if self.short:
            self.heads = np.zeros((16, len(left)), np.uint32)
            if len(left):
                self.heads[:] = np.frombuffer(b"".join(x.ljust(64, b"\0") for x in self.left), "<u4").reshape(-1, 16).T

    def tails(self, size: int) -> np.ndarray:
        """The blocks' words that right ids give after a left text of this size."""
        if size not in self.blocks:
            joined = b"".join((b"\0" * size + x + b"\x80").ljust(56, b"\0") + (8 * (size + len(x))).to_bytes(8, "little") for x in self.right)
            self.blocks[size] = np.ascontiguousarray(np.frombuffer(joined, "<u4").reshape(-1, 16).T)
        return self.blocks[size]

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.uint32)
        if not self.short:
            for at, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
                out[at] = int.from_bytes(hashlib.md5(self.left[x] + self.right[y]).digest()[:4], "big")
            return out
        sizes = self.sizes[i]
        for size in np.unique(self.sizes).tolist():
            at = np.flatnonzero(sizes == size)
            tails = self.tails(size)
            used = [bool(h.any()) or bool(t.any()) for h, t in zip(self.heads, tails, strict=True)]
            for lo in range(0, len(at), CHUNK):
                part = at[lo : lo + CHUNK]
                x, y = i[part], j[part]
                words = [self.heads[w][x] | tails[w][y] if used[w] else 0 for w in range(16)]
                out[part] = first_word(words, len(part))
        return out


def least_of_bin(left: pa.Table, right: pa.Table, names: tuple[str, ...], seed: int) -> pa.Table:
    """s1_id, target_id, _h: of each row of left the `_most` pairs of least digest that belong to its cell."""
    left, right = left.sort_by("cell"), right.sort_by("cell")
    cell = right["cell"].to_numpy()
    lo, hi = (np.searchsorted(cell, left["cell"].to_numpy(), side=s) for s in ("left", "right"))
    meets = np.flatnonzero(hi > lo)
    upto = np.concatenate([[0], np.cumsum((hi - lo)[meets])])
    x = [left[n].to_numpy() for n in names]
    y = [np.where(h == 0, 1, h) for h in (right[n].to_numpy() for n in names)]
    kind, most = left["kind"].to_numpy().astype(np.int64), left["_most"].to_numpy()
    # An id has rows of several kinds of key; it is written into blocks once.
    sides = [t[c].combine_chunks().dictionary_encode() for t, c in ((left, "s1_id"), (right, "target_id"))]
    ids = [s.dictionary for s in sides]
    place = [s.indices.to_numpy().astype(np.int64) for s in sides]
    digests = Digests(*(d.to_pylist() for d in ids), seed)
    by_id = pc.sort_indices(ids[1]).to_numpy().astype(np.int64)
    rank = np.empty_like(by_id)
    rank[by_id] = np.arange(len(by_id))
    found, start = [], 0
    while start < len(meets):
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + best_pairs.PAIRS, side="right")) - 1)
        own, counts = meets[start:end], np.diff(upto[start : end + 1])
        i = np.repeat(np.arange(len(own)), counts)
        j = np.arange(upto[end] - upto[start]) + np.repeat(lo[own] - (upto[start:end] - upto[start]), counts)
        if kind[own].any():
            # A pair that shares an earlier kind of key belongs to the cell of that.
            first, kinds = np.ones(len(i), bool), kind[own][i]
            for at in range(len(names) - 1):
                later = np.flatnonzero(kinds > at)
                first[later] &= x[at][own[i[later]]] != y[at][j[later]]
            i, j = i[first], j[first]
        h = digests.of(place[0][own][i], place[1][j])
        # Most pairs are above the least digests by far; rows of which too few seem least are taken whole.
        want, n = most[own], np.bincount(i, minlength=len(own))
        share = (want + 4 * np.sqrt(want) + 8) / np.maximum(n, 1)
        near = h <= (np.minimum(share, 1) * (2**32 - 1))[i]
        few = np.bincount(i[near], minlength=len(own)) < np.minimum(want, n)
        near |= few[i]
        i, j, h = i[near], j[near], h[near]
        order = np.lexsort((rank[place[1][j]], h, i))
        i, j, h = i[order], j[order], h[order]
        nth = np.arange(len(i)) - np.searchsorted(i, np.arange(len(own)))[i]
        kept = nth < want[i]
        found.append((place[0][own][i[kept]], place[1][j[kept]], h[kept].astype(np.int64)))
        start = end
    rows, cols, h = (np.concatenate([np.empty(0, np.int64), *(f[k] for f in found)]) for k in range(3))
    return pa.table({"s1_id": ids[0].take(pa.array(rows)), "target_id": ids[1].take(pa.array(cols)), "_h": pa.array(h)})


def negatives(
    positives: DataFrame,
    probes: DataFrame,
    targets: DataFrame,
    names: tuple[str, ...] = K.PRODUCTION,
    caps: dict[str, int] | None = None,
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows,
    ratio: int = 5,
    least: int = 3,
    seed: int = 42,
) -> DataFrame:
    """s1_id, target_id: sampling.negatives of blocking.evidence. Tables where records repeat an id list all pairs."""
    limits = {n: K.KEYS[n].cap for n in names if K.KEYS[n].cap} if caps is None else caps
    hashes = [keep(f"keys-{side}", best_pairs.key_hashes(rows, names)) for side, rows in (("s1", probes), ("target", targets))]
    sizes = [rows.agg(F.count("*"), F.countDistinct("entity_id")).first() for rows in hashes]
    if any(n != ids for n, ids in sizes):
        pairs = blocking.classes(probes, targets, names, limits, keep).members()
        return sampling.negatives(positives, pairs.select("s1_id", "target_id"), ratio, least, seed).select("s1_id", "target_id")
    many = positives.groupBy("s1_id").agg(F.count("*").alias("_pos"))
    draw = F.greatest(F.lit(ratio) * F.coalesce("_pos", F.lit(0)), F.lit(least)).cast("long")
    one, two = (
        best_pairs.capped(rows, names, limits if side == "target" else {}).filter(F.coalesce(*names).isNotNull()).fillna(0, list(names))
        for side, rows in zip(("s1", "target"), hashes, strict=True)
    )
    one = one.withColumnRenamed("entity_id", "s1_id").join(many, "s1_id", "left").withColumn("_most", draw + F.coalesce("_pos", F.lit(0)))
    left = best_pairs.cells_of(one, names, "s1_id", "_most")
    right = best_pairs.cells_of(two.withColumnRenamed("entity_id", "target_id"), names, "target_id")
    bins = 1 + sum(n for n, _ in sizes) * len(names) // best_pairs.ROWS
    left, right = best_pairs.dealt(left, right, ("s1_id", "_most"), ("target_id",), names, bins)

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        return least_of_bin(x, y, names, seed)

    near = left.groupBy("bin").cogroup(right.groupBy("bin")).applyInArrow(run, "s1_id string, target_id string, _h long")
    rest = near.join(positives.select("s1_id", "target_id"), ["s1_id", "target_id"], "left_anti").join(many, "s1_id", "left")
    w = Window.partitionBy("s1_id").orderBy("_h", "target_id")
    return rest.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= draw).select("s1_id", "target_id")
