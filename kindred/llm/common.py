"""What the operators of this package share: scratch tables, row sources and small column helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.sources.scratch import materialize, scratch_path, shared_dir  # noqa: F401  (for the operators)

#: Records in one Arrow batch: bounds what a Python worker holds at once, also where texts are long.
ARROW_ROWS = 1000
#: Names of malloc.h.
M_MMAP_THRESHOLD, M_TRIM_THRESHOLD, M_ARENA_MAX = -3, -1, -8


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for a document whose id, written as text, has crc32 = 1 modulo 3; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def hash_uniform(col: Column, seed: int) -> Column:
    """A uniform double in (0, 1) from the md5 of seed and value (52 bits): the same in each rerun and in any engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(col.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def prefix_offsets(counts: DataFrame, order: str, n: str, out: str) -> DataFrame:
    """Adds the sum of n over all rows before; for tables of one row a file or shard."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long"))


def one_of_each(rows: DataFrame, *by: str) -> DataFrame:
    """One row of each value of `by`, the one with the least hash; tasks leave out others before they exchange rows."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(*[c for c, t in rows.dtypes if "map<" not in t]))
    return rows.withColumn("_copy", F.row_number().over(w)).filter("_copy = 1").drop("_copy")


def append_columns(
    df: DataFrame, text: str, make: Callable[[], Callable[[list], list[pa.Array]]], added: list[tuple[str, str]]
) -> DataFrame:
    """df with columns computed from one text column, batch by batch; columns of these names are replaced.

    make() is called once in each task and gives a function from a list of texts to one Arrow array a column.
    """
    base = df.drop(*[n for n, _ in added])
    named = ", ".join(f"`{n}` {t}" for n, t in base.dtypes + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in batches:
            function = function or make()
            columns = function(batch.column(batch.schema.get_field_index(text)).to_pylist())
            names = [*batch.schema.names, *(n for n, _ in added)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)
        del function
        release_memory()

    return base.mapInArrow(run, named)


def hash_sample(ids: DataFrame, key: str, by: str, rows: int, seed: int) -> DataFrame:
    """For each value of `by`, of which there must be few, the greatest hash of `key` among the `rows` least: by, _bar.
    A sample that reruns agree on.

    Only hashes of the least share of each value's rows, twice what is wanted, are ranked: no value is a hot window.
    """
    counts = ids.groupBy(by).agg(F.count("*").alias("_n"))
    hashed = ids.select(by, sample_hash(key, seed).alias("_h")).join(F.broadcast(counts), by)
    share = F.least(F.lit(1.0), F.lit(2.0 * rows + 200) / F.col("_n"))
    low = hashed.filter(F.col("_h") <= (share * 2.0**64 - 2.0**63).cast("long"))
    w = Window.partitionBy(by).orderBy("_h")
    ranked = low.withColumn("_rn", F.row_number().over(w))
    return ranked.filter(F.col("_rn") <= rows).groupBy(by).agg(F.max("_h").alias("_bar"))


def sample_hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def release_memory() -> None:
    """Give freed memory back to the system, where the C library can; the driver has little, and a Python worker lives on
    beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def return_large_blocks() -> None:
    """Have the C library, where it is glibc, give large arrays back as they are freed. Left to itself it raises these
    limits to the largest array it has seen, and a worker keeps what one stage needed through all that follow."""
    with contextlib.suppress(AttributeError, OSError):
        option = ctypes.CDLL(None).mallopt
        for name, value in ((M_MMAP_THRESHOLD, 1 << 20), (M_TRIM_THRESHOLD, 4 << 20), (M_ARENA_MAX, 2)):
            option(name, value)


return_large_blocks()
