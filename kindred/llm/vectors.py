"""Vectors as bytes: validity, packing, and back to numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lengths(vectors: DataFrame, column: str = "embedding") -> dict[int, int]:
    """How many vectors there are of each length above 0."""
    sizes = vectors.filter(F.size(column) > 0).groupBy(F.size(column).alias("d")).agg(F.count("*").alias("m"))
    return {r["d"]: r["m"] for r in sizes.collect()}


def packed(vectors: DataFrame, id_col: str, column: str, d: int) -> DataFrame:
    """The vectors of d components that take part, as (id_col, vec: bytes of 32-bit floats, or of 64-bit ones where a
    component needs them).

    Left out are null ids and vectors that are null, zero, or hold a component that is null or not finite.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            right = np.asarray(lists.value_lengths().fill_null(-1)) == d
            right &= np.asarray(batch.column(0).is_valid())
            at = np.flatnonzero(right)
            flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = flat.reshape(len(at), d)
            good = np.isfinite(matrix).all(1) & (matrix != 0).any(1)
            at, matrix = at[good], matrix[good] + 0.0  # no -0
            with np.errstate(over="ignore"):
                short = matrix.astype(np.float32)
            exact = (short == matrix).all(1)
            bytes_ = [(s if e else m).tobytes() for s, m, e in zip(short, matrix, exact, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(bytes_, pa.binary())], names=[id_col, "vec"]
            )

    rows = vectors.select(F.col(id_col).cast("long"), F.col(column).cast("array<double>"))
    return rows.filter(F.size(column) == d).mapInArrow(pack, f"{id_col} long, vec binary")


def matrix(column, d: int) -> np.ndarray:
    """A column of packed vectors as an array of doubles of shape (n, d)."""
    rows = list(column)
    if all(len(r) == 4 * d for r in rows):
        return np.frombuffer(b"".join(rows), np.float32).reshape(-1, d).astype(np.float64)
    return np.array([np.frombuffer(r, np.float32 if len(r) == 4 * d else np.float64) for r in rows], np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by their greatest component first, so that squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.sqrt((x * x).sum(1, keepdims=True))
