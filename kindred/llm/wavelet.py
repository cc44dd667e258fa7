"""Operator 10, token-id output: one compressed file a shard holding a wavelet matrix over its token ids.

A wavelet matrix (Claude, Navarro, Ordonez 2015) keeps one bit-plane for each bit of the ids, the highest first; each
plane orders the ids stably by the bit of the plane above. A plane answers rank and select, and so the matrix gives the
id at a position, the count of an id in a range and the place of its k-th occurrence.

File: magic, then the planes in chunks of CHUNK bits, each compressed by zstd where that makes it smaller, then a footer
(document ids and lengths, for each plane its zeros and where its chunks lie and how many ones come before each) and
its length. A lookup reads the footer and one or two chunks a plane, and nothing else of the file. Shards hold
documents in ascending doc_id, null first, equal ids ordered by a hash of their text, and are closed at SHARD_IDS ids: so
their size does not grow with the data.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common, storage, tokens

MAGIC = b"KWM2"
#: Ids at which a shard is closed; its last document may exceed it.
SHARD_IDS = 1 << 21
CHUNK = 1 << 16
#: Of zstd; planes of ids are half random, stronger levels gain little.
LEVEL = 1
#: Chunks that an open shard remembers.
HELD_CHUNKS = 128


class Bits:
    """A bit-plane with rank and select. chunk(j) gives the bytes of chunk j, ones[j] counts the ones before it."""

    def __init__(self, n: int, ones: np.ndarray, chunk: Callable[[int], np.ndarray]):
        self.n, self.ones, self.chunk = n, ones, chunk

    def get(self, i: int) -> int:
        return int(self.chunk(i // CHUNK)[i % CHUNK >> 3]) >> (7 - (i & 7)) & 1

    def rank(self, bit: int, i: int) -> int:
        """How many of the first i bits equal bit."""
        j, rest = divmod(i, CHUNK)
        r = int(self.ones[j])
        if rest:
            chunk = self.chunk(j)
            r += int(np.bitwise_count(chunk[: rest >> 3]).sum(dtype=np.int64))
            if rest & 7:
                r += (int(chunk[rest >> 3]) >> (8 - (rest & 7))).bit_count()
        return r if bit else i - r

    def select(self, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit that equals bit."""
        before = self.ones if bit else np.arange(len(self.ones), dtype=np.int64) * CHUNK - self.ones
        j = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.chunk(j), count=min(CHUNK, self.n - j * CHUNK))
        return j * CHUNK + int(np.flatnonzero(bits == bit)[k - int(before[j])])


class WaveletMatrix:
    def __init__(self, planes: list[Bits], zeros: list[int], n: int):
        self.planes, self.zeros, self.n = planes, zeros, n

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        """Plane by plane, each in chunks that stay in the processor's cache."""
        levels, n = max(1, int(values.max(initial=0)).bit_length()), len(values)
        v = values.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros, below = [], [], np.empty_like(v)
        for level in reversed(range(levels)):
            shift, bits = v.dtype.type(level), []
            for at in range(0, n, CHUNK):
                bits.append(((v[at : at + CHUNK] >> shift).astype(np.uint8) & 1).view(bool))
            ones = np.cumsum([0, *map(np.count_nonzero, bits)])
            low, high = 0, n - int(ones[-1])
            zeros.append(high)
            for at, bit in zip(range(0, n, CHUNK), bits, strict=True):
                part = v[at : at + CHUNK]
                # compress is several times as fast as an index of booleans.
                for chosen, to in ((np.compress(~bit, part), low), (np.compress(bit, part), high)):
                    below[to : to + len(chosen)] = chosen
                k = int(np.count_nonzero(bit))
                low, high = low + len(bit) - k, high + k
            planes.append(Bits(n, ones, [np.packbits(b) for b in bits].__getitem__))
            v, below = below, v
        return cls(planes, zeros, n)

    def decode(self) -> np.ndarray:
        """All ids in order: each plane deals what is below it back to the places of its zeros and ones."""
        levels, n = len(self.planes), self.n
        v = np.zeros(n, np.uint16 if levels <= 16 else np.uint32)
        up = np.empty_like(v)
        for level in reversed(range(levels)):
            plane, low, high = self.planes[level], 0, self.zeros[level]
            one = v.dtype.type(1 << (levels - 1 - level))
            for j, at in enumerate(range(0, n, CHUNK)):
                bit = np.unpackbits(plane.chunk(j), count=min(CHUNK, n - at)).view(bool)
                part, k = up[at : at + CHUNK], int(plane.ones[j + 1] - plane.ones[j])
                part[np.flatnonzero(~bit)] = v[low : low + len(bit) - k]
                part[np.flatnonzero(bit)] = v[high : high + k] | one
                low, high = low + len(bit) - k, high + k
            v, up = up, v
        return v

    def access(self, i: int) -> int:
        out = 0
        for plane, z in zip(self.planes, self.zeros, strict=True):
            bit = plane.get(i)
            out = out << 1 | bit
            i = plane.rank(bit, i) + z * bit
        return out

    def _span(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of value in [lo, hi) lie below the last plane."""
        if value < 0 or value >> len(self.planes):
            return 0, 0
        for level, (plane, z) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = value >> (len(self.planes) - 1 - level) & 1
            lo, hi = plane.rank(bit, lo) + z * bit, plane.rank(bit, hi) + z * bit
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of value in positions [lo, hi)."""
        a, b = self._span(value, lo, self.n if hi is None else hi)
        return b - a

    rank = count

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of value; IndexError if there are not as many."""
        a, b = self._span(value, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - level) & 1
            i = self.planes[level].select(bit, i - self.zeros[level] * bit)
        return i


class ShardWriter:
    """Gathers the documents of one shard and writes their matrix to a file."""

    def __init__(self):
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.held: list[bytes] = []
        self.n = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit."""
        self.docs.append(doc_id)
        self.sizes.append(len(ids) // 4)
        self.held.append(ids)
        self.n += len(ids) // 4

    def write(self, out: io.IOBase) -> None:
        import zstandard

        out.write(MAGIC)
        ids = np.frombuffer(b"".join(self.held), "<u4")
        self.held.clear()
        matrix, at, table, ones = WaveletMatrix.build(ids), len(MAGIC), [], []
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        for plane in matrix.planes:
            for j in range(len(plane.ones) - 1):
                raw = plane.chunk(j).tobytes()
                data = squeeze(raw)
                data = data if len(data) < len(raw) else raw
                out.write(data)
                table.append((at, len(data)))
                at += len(data)
            ones.append(plane.ones)
        known = np.array([d is not None for d in self.docs], bool)
        body = [
            np.packbits(known).tobytes(),
            np.array([d or 0 for d in self.docs], "<i8").tobytes(),
            np.array(self.sizes, "<u8").tobytes(),
            np.array(matrix.zeros, "<u8").tobytes(),
            np.array(table, "<u8").reshape(-1, 2).tobytes(),
            np.array(ones, "<u8").tobytes(),
        ]
        head = json.dumps({"docs": len(self.docs), "planes": len(matrix.planes), "ids": self.n}).encode()
        foot = zstandard.ZstdCompressor(level=3).compress(struct.pack("<I", len(head)) + head + b"".join(body))
        out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)


class Shard:
    """One shard file (bytes, or an open file that can seek): documents one after another, or single ids, counts and
    occurrences. Chunks are read when they are needed."""

    def __init__(self, file: bytes | BinaryIO):
        import zstandard

        self.file = io.BytesIO(file) if isinstance(file, bytes) else file
        end, tail = self.file.seek(0, 2), 8 + len(MAGIC)
        if end < tail + len(MAGIC) or self.read(0, 4) != MAGIC or self.read(end - 4, 4) != MAGIC:
            raise ValueError("not a shard file")
        (size,) = struct.unpack("<Q", self.read(end - tail, 8))
        raw = zstandard.ZstdDecompressor().decompress(self.read(end - tail - size, size))
        (m,) = struct.unpack_from("<I", raw)
        head, at = json.loads(raw[4 : 4 + m]), 4 + m
        d, planes, self.n = head["docs"], head["planes"], head["ids"]
        chunks = -(-self.n // CHUNK)

        def numbers(kind: str, n: int) -> np.ndarray:
            nonlocal at
            at += 8 * n
            return np.frombuffer(raw, kind, n, at - 8 * n)

        known = np.unpackbits(np.frombuffer(raw, np.uint8, -(-d // 8), at), count=d)
        at += -(-d // 8)
        self.doc_ids = [x if k else None for x, k in zip(numbers("<i8", d).tolist(), known, strict=True)]
        self.sizes = numbers("<u8", d).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        zeros = numbers("<u8", planes).astype(int).tolist()
        self.table = numbers("<u8", 2 * planes * chunks).reshape(planes, chunks, 2).astype(np.int64)
        ones = numbers("<u8", planes * (chunks + 1)).reshape(planes, chunks + 1).astype(np.int64)
        held = lru_cache(maxsize=HELD_CHUNKS)(self.chunk)
        self.matrix = WaveletMatrix([Bits(self.n, ones[p], partial(held, p)) for p in range(planes)], zeros, self.n)

    def read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def chunk(self, plane: int, j: int) -> np.ndarray:
        import zstandard

        at, size = self.table[plane, j].tolist()
        data, wide = self.read(at, size), -(-min(CHUNK, self.n - j * CHUNK) // 8)
        return np.frombuffer(data if size == wide else zstandard.ZstdDecompressor().decompress(data), np.uint8)

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return self.matrix.access(i)

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of value in positions [lo, hi) of the shard."""
        return self.matrix.count(value, lo, hi)

    def occurrences(self, value: int) -> Iterator[int]:
        """Positions of value in the shard, ascending."""
        for k in range(self.matrix.count(value)):
            yield self.matrix.select(value, k)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, start in the shard, ids as little-endian unsigned 32-bit)."""
        ids = self.matrix.decode()
        for doc, lo, size in zip(self.doc_ids, self.starts.tolist(), self.sizes.tolist(), strict=False):
            yield doc, lo, ids[lo : lo + size].astype("<u4").tobytes()


MANIFEST = "shard long, uri string, n_docs long, n_ids long"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, tasks: int | None = None) -> DataFrame:
    """Encode whole texts (null: empty), append end_id, write shard files of about SHARD_IDS ids in ascending doc_id.

    docs: doc_id, text; other columns are ignored. Returns the manifest (shard: its place in order, uri, n_docs, n_ids),
    written to the shared folder: it names the files of the attempts that succeeded, so files of lost executors are never
    read. tasks is the number of ranges of doc_id that are written side by side. Repeated rows are written each; an empty
    table gives an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens.tokenizer(tokenizer), np.array([end_id], "<u4").tobytes()
        part, made, writer = TaskContext.get().partitionId(), 0, ShardWriter()

        def done() -> pa.RecordBatch:
            uri = f"{folder}/shard-{part:05d}-{made:05d}-{uuid.uuid4().hex}.kwm"
            with storage.open_write(uri) as out:
                writer.write(out)
            columns = [[(part << 32) + made], [uri], [len(writer.docs)], [writer.n]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "uri", "n_docs", "n_ids"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                writer.add(doc, encoder.encode(text) + end)
                if writer.n >= SHARD_IDS:
                    yield done()
                    made, writer = made + 1, ShardWriter()
        if writer.docs:
            yield done()

    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("_h", F.xxhash64("text"))
    by = ("doc_id", "_h")
    dealt = rows.repartitionByRange(tasks, *by) if tasks else rows.repartitionByRange(*by)
    return common.materialize(
        dealt.sortWithinPartitions(*by).select("doc_id", "text").mapInArrow(write, MANIFEST), "manifest"
    )


def read_shards(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """The documents of shard files: doc_id, start (ids of all documents before it), n_tokens, and ids (binary) or, without
    them, their checksum ids_crc32, so that ids that are only to be compared don't leave the task that reads them."""
    last = ("ids", "binary", pa.binary()) if ids else ("ids_crc32", "long", pa.int64())
    schema = f"doc_id long, start long, n_tokens long, {last[0]} {last[1]}"
    names = ["doc_id", "start", "n_tokens", last[0]]
    types = [pa.int64(), pa.int64(), pa.int64(), last[2]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
            )

        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                with storage.open_seekable(uri) as file:
                    for doc, lo, raw in Shard(file).documents():
                        rows.append((doc, base + lo, len(raw) // 4, raw if ids else zlib.crc32(raw)))
                        size += len(raw) if ids else 100
                        if size >= 1 << 20:
                            yield flush(rows)
                            rows, size = [], 0
                if rows:
                    yield flush(rows)

    placed = common.prefix_offsets(manifest, "shard", "n_ids", "base").select("uri", "base")
    return placed.repartition(common.parts(manifest.sparkSession)).mapInArrow(read, schema)
