"""Samples and splits that reruns agree on. [SL5-SL11]"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(c: Column | str, seed: int = 42) -> Column:
    """A uniform number below 2 ** 32 from the md5 of seed and value."""
    text = F.concat(F.lit(f"{seed}:"), F.col(c) if isinstance(c, str) else c.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def holdout(df: DataFrame, entity: str = "s1_id", tenths: int = 2, seed: int = 42) -> DataFrame:
    """Adds held_out, for a number of tenths of the entities: all pairs of an entity lie on one side. [SL10]"""
    return df.withColumn("held_out", digest(entity, seed) % 10 < tenths)


def every_nth(df: DataFrame, n: int = 30, most: int | None = None) -> DataFrame:
    """Systematic sample in read order. [SL9]"""
    out = df.filter(F.col("ord") % n == 0)
    return out.orderBy("ord").limit(most) if most else out


def shuffled(df: DataFrame, key: str, most: int, seed: int = 42) -> DataFrame:
    """[SL6]"""
    return df.orderBy(digest(key, seed), key).limit(most)


def negatives(positives: DataFrame, pairs: DataFrame, ratio: int = 5, least: int = 3, seed: int = 42) -> DataFrame:
    """Of each S1's pairs that are no positives, `ratio` for each of its positives and at least `least`. [SL8]"""
    many = positives.groupBy("s1_id").agg(F.count("*").alias("_pos"))
    rest = pairs.join(positives, ["s1_id", "target_id"], "left_anti").join(many, "s1_id", "left").fillna(0, ["_pos"])
    w = Window.partitionBy("s1_id").orderBy(digest(F.concat_ws("|", "s1_id", "target_id"), seed), "target_id")
    rows = rest.withColumn("_rn", F.row_number().over(w))
    return rows.filter(F.col("_rn") <= F.greatest(F.lit(ratio) * F.col("_pos"), F.lit(least))).drop("_rn", "_pos")


def random_negative(positives: DataFrame, pool: DataFrame, seed: int = 42) -> DataFrame:
    """For each positive a pair of its S1 with a record of the pool (entity_id) that is none of its targets. [SL7]

    Both sides are numbered by hash within buckets, so neither is sorted as a whole.
    """
    width = 64
    bucket = lambda c: F.pmod(digest(c, seed), F.lit(width)).alias("_b")
    numbered = pool.select("entity_id", bucket("entity_id"))
    w = Window.partitionBy("_b").orderBy(digest("entity_id", seed + 1), "entity_id")
    numbered = numbered.withColumn("_i", F.row_number().over(w) - 1)
    sizes = numbered.groupBy("_b").agg(F.count("*").alias("_n"))
    pair = F.concat_ws("|", "s1_id", "target_id")
    asked = positives.select("s1_id", "target_id", bucket(pair), digest(pair, seed + 2).alias("_h")).join(sizes, "_b")
    drawn = asked.withColumn("_i", F.pmod("_h", "_n").cast("int")).join(numbered, ["_b", "_i"])
    out = drawn.select("s1_id", F.col("entity_id").alias("target_id")).distinct()
    return out.join(positives, ["s1_id", "target_id"], "left_anti")


def balanced(df: DataFrame, label: str, each: int, key: str, seed: int = 42) -> DataFrame:
    """At most `each` rows of either label. [SL11]"""
    return shuffled(df.filter(F.col(label) == 1), key, each, seed).unionByName(
        shuffled(df.filter(F.col(label) == 0), key, each, seed)
    )


def most_common(df: DataFrame, column: str, n: int) -> DataFrame:
    """[SL5]"""
    return df.groupBy(column).count().orderBy(F.desc("count"), column).limit(n)
