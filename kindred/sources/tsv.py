"""Reading and writing tab-separated records, candidates and matches. [SC1-SC13, SK1-SK4, SK7]"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import text as T
from kindred.sources import scratch

SCHEMA = "entity_id string, business_name string, business_address string, country string, _bad string"


def _reader(spark: SparkSession):
    return (
        spark.read.option("sep", "\t").option("header", True).option("mode", "PERMISSIVE").option("emptyValue", "")
        .option("nullValue", "\x00").option("maxCharsPerColumn", -1).option("enforceSchema", True)
        .option("escape", '"')
    )


def read_records(spark: SparkSession, paths: list[str], strict: bool = True, short_rows: str = "drop") -> DataFrame:
    """entity_id, name, address, country and ord, the place in reading order, of the files in order.

    A file that is missing raises, or is left out where not strict. Rows of fewer than four fields are dropped
    ("drop"), or missing fields are empty ("pad"). Ids, postal codes and the like stay text.
    """
    found = [p for p in paths if strict or scratch.exists(spark, p)]
    out = None
    for i, path in enumerate(found):
        rows = _reader(spark).schema(SCHEMA).option("columnNameOfCorruptRecord", "_bad").csv(path)
        ord_ = F.lit(i * (1 << 52)) + F.monotonically_increasing_id()
        rows = rows.select("*", ord_.alias("ord"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], SCHEMA + ", ord long")
    if short_rows == "drop":
        out = out.filter(F.col("country").isNotNull())
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    return out.select(
        text("entity_id").alias("entity_id"),
        text("business_name").alias("name"),
        text("business_address").alias("address"),
        text("country").alias("country"),
        "ord",
    )


def short_rows(spark: SparkSession, path: str) -> int:
    """How many rows have fewer than four fields."""
    rows = _reader(spark).schema(SCHEMA).option("columnNameOfCorruptRecord", "_bad").csv(path)
    return rows.filter(F.col("country").isNull()).count()


def read_lists(spark: SparkSession, path: str, value: str = "matched", optional: bool = False) -> DataFrame:
    """s1_id and an array of ids, distinct, in order: truth, candidates or matches. [SC3, SC7, SC8]"""
    if optional and not scratch.exists(spark, path):
        return spark.createDataFrame([], f"s1_id string, {value} array<string>")
    rows = _reader(spark).schema("s1_id string, ids string").csv(path)
    ids = F.transform(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: F.trim(x))
    return rows.select(F.trim("s1_id").alias("s1_id"), F.array_distinct(F.filter(ids, lambda x: x != "")).alias(value))


def pairs_of(lists: DataFrame, value: str = "matched") -> DataFrame:
    """Long form of lists: s1_id, target_id."""
    return lists.select("s1_id", F.explode(value).alias("target_id"))


def needed(records: DataFrame, ids: DataFrame, id_col: str = "target_id") -> DataFrame:
    """Only records whose id is asked for. [SC5]"""
    return records.join(ids.select(F.col(id_col).alias("entity_id")).distinct(), "entity_id", "left_semi")


def first_rows(records: DataFrame, n: int | None) -> DataFrame:
    """The first n records in reading order; all of them without n. [SC4, SL12]"""
    return records if n is None else records.orderBy("ord", "entity_id").limit(n)


def entity_texts(records: DataFrame) -> DataFrame:
    """entity_id, name, the text that an encoder reads, and country. [SC6]"""
    return records.select("entity_id", T.present("name").alias("name"), T.encoder_text("name", "address").alias("text"), "country")


def write_records(records: DataFrame, path: str) -> None:
    """Records as read_records reads them. [SC1, SC2]"""
    rows = records.select(
        "entity_id", F.col("name").alias("business_name"), F.col("address").alias("business_address"), "country"
    )
    rows.write.option("sep", "\t").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def lists_of(s1: DataFrame, ranked: DataFrame, header: str, order: str = "rank") -> DataFrame:
    """One row for each S1 record, in read order, with its targets as a comma list, empty if it has none. [SK1, SK2, J21]"""
    listed = F.array_sort(F.collect_list(F.struct(order, "target_id")))
    per = ranked.groupBy("s1_id").agg(F.array_join(F.transform(listed, lambda x: x["target_id"]), ",").alias(header))
    rows = s1.select(F.col("entity_id").alias("s1_id"), "ord").join(per, "s1_id", "left")
    return rows.select("ord", F.col("s1_id").alias("source1_entity_id"), F.coalesce(header, F.lit("")).alias(header))


def write_lists(lists: DataFrame, path: str) -> None:
    """Write beside the target, then move the old result aside, the new one in, and delete the old. A crash in between
    loses neither: there is always one of them under the target's name or beside it. [SK7]"""
    spark = lists.sparkSession
    fresh, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    rows = lists.repartitionByRange("ord").sortWithinPartitions("ord").drop("ord")
    rows.write.option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "").csv(fresh)
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(target)
    if had and not fs.rename(target, jvm.Path(old)):
        raise OSError(f"could not move {path} aside to {old}")
    if not fs.rename(jvm.Path(fresh), target):
        raise OSError(f"could not move {fresh} to {path}; the result before is at {old if had else None}")
    if had:
        fs.delete(jvm.Path(old), True)
