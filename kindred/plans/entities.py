"""Business records from the driver's tables: entity_id, source, name, address, country, ord.

A document stands for a record: its first four words name it, the next twelve and a number are its address, its
language is its country, and its id deals it to one of three sources. Exact copies of texts in other sources are what
truly matches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources import scratch

#: Stand-ins for countries, and words that stand for places, so that country rules and gazetteers have work to do.
LANDS = {"en": "us", "fr": "france", "de": "india"}
PLACES_FRANCE = ["de", "la", "le", "les", "des", "un", "une", "et", "en", "que"]
PLACES_INDIA = ["der", "die", "das", "und", "den", "ist", "von", "zu", "mit", "ein"]


_memo: ContextVar[dict[str, DataFrame] | None] = ContextVar("staged", default=None)


@contextmanager
def staging() -> Iterator[None]:
    """While a query is put together, staged() writes each table once."""
    token = _memo.set({})
    try:
        yield
    finally:
        _memo.reset(token)


def staged(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table that make() gives; where several branches of a query read it, written to the shared folder once."""
    known = _memo.get()
    if known is None:
        return make()
    if name not in known:
        known[name] = scratch.materialize(make(), name.partition(":")[0])
    return known[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _first_words() -> Column:
    """Of a text its first sixteen words; no more is parted from it. It may begin with white space."""
    parts = F.filter(F.slice(F.split("text", r"\s+", 18), 1, 17), lambda t: t != "")
    return F.slice(parts, 1, 16)


def _source() -> Column:
    return F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"))


def _entity_id() -> Column:
    return F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("entity_id")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "lang", "n_chars", _first_words().alias("w"), _source().alias("source"))
    return rows.select(
        _entity_id(),
        "source",
        F.lower(F.array_join(F.slice("w", 1, 4), " ")).alias("name"),
        F.concat_ws(" ", F.expr("n_chars div 100").cast("string"), F.lower(F.array_join(F.slice("w", 5, 12), " "))).alias("address"),
        F.col("lang").alias("country"),
        F.col("doc_id").alias("ord"),
    )


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """S1 records, and those of S2 and S3."""
    rows = staged(f"records:{sf_dir}", lambda: records(spark, sf_dir))
    return rows.filter("source = 'S1'"), rows.filter("source <> 'S1'")


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, content: a digest of the words of a text.

    Only of texts that begin with the same words as one of the other side: no other can match.
    """
    docs = table(spark, sf_dir, "documents").filter("text is not null").withColumn("source", _source())
    begins = F.xxhash64(F.lower(F.array_join(_first_words(), " "))).alias("begins")
    sides = docs.select(begins, (F.col("source") == "S1").alias("one")).groupBy("begins").agg(F.countDistinct("one").alias("n"))
    words = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))
    rows = docs.select("doc_id", "source", "text", begins).join(sides.filter("n = 2"), "begins", "left_semi")
    return rows.select(_entity_id(), "source", F.md5(words.cast("binary")).alias("content"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, target_id: records whose whole texts have the same words."""
    known, name = _memo.get(), f"contents:{sf_dir}"
    rows = contents(spark, sf_dir) if known is None else known.get(name)
    if rows is None:
        rows = known[name] = scratch.cached(spark, scratch.scratch_path(spark, "contents"), lambda: contents(spark, sf_dir))
    left = rows.filter("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "content")
    return left.join(rows.filter("source <> 'S1'").select(F.col("entity_id").alias("target_id"), "content"), "content").drop("content")


def landed(rows: DataFrame) -> DataFrame:
    """Countries by LANDS."""
    return rows.withColumn("country", F.coalesce(*[F.when(F.col("country") == k, v) for k, v in LANDS.items()], "country"))
