"""Operator 5, packing: best-fit decreasing over token pieces.

Documents longer than a window are first cut into full windows. What is left of each document goes, longest first,
into the tightest open window that still has room; a segment tree over remaining capacities finds it. Pieces are dealt
by hash to shards of about SHARD that pack on their own, so no task grows with the input and one shard leaves at most a
few loose windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common, tokens

WINDOW = 2048
SHARD = 40_000


class Capacities:
    """Segment tree over remaining capacities 0..top: which have an open window, and the least that is at least x."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(top + 1)]

    def push(self, room: int, window: int) -> None:
        self.open[room].append(window)
        i = room + self.size
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def pop(self, room: int) -> int:
        window = self.open[room].pop()
        if not self.open[room]:
            i = room + self.size
            self.any[i] = 0
            while i > 1 and not self.any[i ^ 1]:
                i >>= 1
                self.any[i] = 0
        return window

    def tightest(self, x: int) -> int | None:
        """The least remaining capacity, at least x, of an open window."""
        i = x + self.size
        while not self.any[i]:
            while i & 1:  # nothing to the right below this parent
                i >>= 1
            i += 1
            if i & (i - 1) == 0:  # past the last node of its level
                return None
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each length (1..window), and the number of windows; ties keep the order given."""
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, n = Capacities(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        room = tree.tightest(size) if size < window else None
        if room is None:
            w, room, n = n, window, n + 1
        else:
            w = tree.pop(room)
        seq[i], off[i] = w, window - room
        if room > size:
            tree.push(room - size, w)
    return seq, off, n


def cut(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, cache: int = tokens.CACHE_PIECES) -> DataFrame:
    """Pieces of at most window ids of every row: doc_id, start, length, doc_tokens, ids (little-endian 32-bit).

    A null or empty text is the end id alone; a row repeated is cut each time; null ids stay null. cache is how many
    pieces of texts a worker remembers.
    """
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release_memory()
        encoder, end = tokens.tokenizer(tokenizer, cache), np.array([end_id], "<u4").tobytes()

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            cols = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                rows += [
                    (doc, lo, min(window, n - lo), n, ids[4 * lo : 4 * (lo + window)]) for lo in range(0, n, window)
                ]
                size += len(ids)
                if size >= 4 << 20:
                    yield flush(rows)
                    rows, size = [], 0
            if rows:
                yield flush(rows)

    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


def assign(pieces: DataFrame, window: int = WINDOW, shard_rows: int = SHARD) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns besides length are carried along); both count from 0.

    Pieces are read twice and must not change between: the caller passes a written table.
    """
    spark = pieces.sparkSession
    shards = max(1, -(-pieces.count() // shard_rows))
    # By place in the written table, as one id, or none, may be that of most rows.
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    out = f"{', '.join(f'`{n}` {t}' for n, t in dealt.dtypes)}, _local long, offset long, _windows long"

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "doc_tokens"], kind="stable", ignore_index=True)
        seq, off, n = best_fit_decreasing(group["length"].to_numpy(), window)
        return group.assign(_local=seq, offset=off, _windows=n)

    packed = common.materialize(dealt.groupBy("_shard").applyInPandas(pack, out), "packed")
    counts = packed.groupBy("_shard").agg(F.max("_windows").alias("_n"))
    base = common.prefix_offsets(counts, "_shard", "_n", "_base").select("_shard", "_base")
    placed = packed.join(F.broadcast(base) if shards <= 10_000 else base, "_shard")
    return placed.withColumn("sequence_id", F.col("_base") + F.col("_local")).drop(
        "_shard", "_base", "_local", "_windows"
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Pieces with their ids, sequence and offset, for all rows of docs (doc_id, text)."""
    return assign(common.materialize(cut(docs, tokenizer, end_id, window), "pieces"), window)
