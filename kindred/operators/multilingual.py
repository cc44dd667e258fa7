"""Matching across scripts: exact names first, then meaning. [KM, KQ, J8, J18, SM14, SM15, PF10]"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import similarity as S
from kindred.functions import text as T
from kindred.functions import vocab
from kindred.operators import keys as K
from kindred.operators.blocking import Classes


def _sides(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with shared address tokens and numbers of their records."""
    side = lambda df, i, key: df.select(
        F.col("entity_id").alias(key), A.address_tokens("address").alias(f"_t{i}"), A.number_set("address").alias(f"_n{i}")
    )
    both = pairs.join(side(s1, 1, "s1_id"), "s1_id").join(side(targets, 2, "target_id"), "target_id")
    shared = {"tokens": S.overlap(F.col("_t1"), F.col("_t2")), "numbers": S.overlap(F.col("_n1"), F.col("_n2"))}
    return both.withColumns(shared).drop("_t1", "_t2", "_n1", "_n2")


def _best(scored: DataFrame, by: Column) -> DataFrame:
    """The best of each source, ties to the record read first."""
    w = Window.partitionBy("s1_id", F.substring("target_id", 1, 2)).orderBy(by.desc(), "ord", "target_id")
    return scored.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("s1_id", "target_id")


def exact_tier(s1: DataFrame, targets: DataFrame) -> DataFrame:
    """s1_id, target_id: of each source the record of the same country and name that agrees best in address."""
    key = K.key_of(F.lower(K.country_of()), T.clean_name("name", vocab.SUFFIXES_MULTILINGUAL))
    left = s1.select(F.col("entity_id").alias("s1_id"), key.alias("key"))
    right = targets.select(F.col("entity_id").alias("target_id"), "ord", key.alias("key"))
    rows = _sides(left.join(right, "key").drop("key"), s1, targets)
    return _best(rows, S.disambiguation(F.col("tokens"), F.col("numbers")))


def pool(s1: DataFrame, targets: DataFrame, postal: int = 15, per_token: int = 10, rare: tuple[int, int] = (2, 4000), most: int = 20) -> DataFrame:
    """s1_id, target_id of records that share the postal code or one of the S1's first three address tokens, in alphabetical
    order, if it is rare; an S1 with more than `most` of them has none: it says too little."""
    side = lambda df: df.select("entity_id", "ord", F.lower(K.country_of()).alias("land"), A.last_postal("address").alias("postal"), A.address_tokens("address").alias("words"))
    left, right = side(s1), side(targets)
    by_code = Window.partitionBy("land", "postal").orderBy("ord", "entity_id")
    coded = right.filter(F.col("postal").isNotNull()).withColumn("_rn", F.row_number().over(by_code)).filter(F.col("_rn") <= postal)
    first = left.select(F.col("entity_id").alias("s1_id"), "land", "postal").join(
        coded.select(F.col("entity_id").alias("target_id"), "land", "postal"), ["land", "postal"]
    )
    tokens = right.select("entity_id", "ord", "land", F.explode("words").alias("token"))
    sizes = tokens.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df").between(*rare))
    by_token = Window.partitionBy("token").orderBy("ord", "entity_id")
    kept = tokens.join(sizes, "token").withColumn("_rn", F.row_number().over(by_token)).filter(F.col("_rn") <= per_token)
    asked = left.select(F.col("entity_id").alias("s1_id"), "land", F.explode(F.slice(F.array_sort("words"), 1, 3)).alias("token"))
    second = asked.join(kept.select("token", "land", F.col("entity_id").alias("target_id")), ["token", "land"])
    found = first.select("s1_id", "target_id").union(second.select("s1_id", "target_id")).distinct()
    n = found.groupBy("s1_id").agg(F.count("*").alias("_n")).filter(F.col("_n") <= most)
    return found.join(n, "s1_id").drop("_n")


def supported(similarity, tokens, numbers):
    """Similar, and agreeing in address; of columns and of arrays."""
    return (similarity >= 0.84) & ((tokens >= 1) | (numbers >= 1)) | (similarity >= 0.70) & (tokens >= 3)


def semantic_tier(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Of pairs (s1_id, target_id, similarity) the best of each source that is similar and agrees in address."""
    rows = _sides(pairs.join(targets.select(F.col("entity_id").alias("target_id"), "ord"), "target_id"), s1, targets)
    ok = supported(*map(F.col, ("similarity", "tokens", "numbers")))
    return _best(rows.filter(ok), S.combined(F.col("similarity"), F.col("tokens"), F.col("numbers")))


def first_acceptable(ranked: DataFrame, s1: DataFrame, targets: DataFrame, high: float = 0.90, low: float = 0.50, tokens: int = 3) -> DataFrame:
    """Of ranked pairs (s1_id, target_id, similarity, rank) the first that is very similar, or similar and supported by
    address tokens, or by a number and a token. [J18]"""
    rows = _sides(ranked, s1, targets)
    support = (F.col("tokens") >= tokens) | ((F.col("numbers") >= 1) & (F.col("tokens") >= 1))
    ok = (F.col("similarity") >= high) | ((F.col("similarity") >= low) & support)
    return rows.filter(ok).groupBy("s1_id").agg(F.min_by("target_id", "rank").alias("target_id"))


def canonical_recovery(s1: DataFrame, targets: DataFrame, most: int = 6) -> DataFrame:
    """s1_id, target_id by canonical place and first word of the name, of each key the first records. [KQ]"""
    land, word = F.lower(K.country_of()), T.first_word(T.super_clean_name("name"))
    key = K.key_of(land, A.canonical_geo("address", land), F.when(F.length(word) >= 3, word))
    right = targets.select("entity_id", "ord", key.alias("key")).filter(F.col("key").isNotNull())
    w = Window.partitionBy("key").orderBy("ord", "entity_id")
    right = right.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most)
    left = s1.select(F.col("entity_id").alias("s1_id"), key.alias("key"))
    return left.join(right, "key").select("s1_id", F.col("entity_id").alias("target_id"))


def with_fallback(found: DataFrame, fallback: DataFrame, fewer_than: int = 5) -> DataFrame:
    """found, and the fallback's pairs of those S1 that have fewer than so many. [J8]"""
    enough = found.groupBy("s1_id").agg(F.countDistinct("target_id").alias("_n")).filter(F.col("_n") >= fewer_than)
    return found.select("s1_id", "target_id").union(fallback.select("s1_id", "target_id").join(enough, "s1_id", "left_anti")).distinct()


def classes_with_fallback(found: Classes, fewer_than: int = 5) -> DataFrame:
    """with_fallback of key A by key D, from pairs of classes: all S1 of a class have as many pairs."""
    sure = Classes(found.pairs.filter("has_a"), found.probes, found.targets)
    sizes = found.targets.groupBy("target_class").agg(F.count("*").alias("_m"))
    enough = sure.pairs.select("s1_class", "target_class").join(sizes, "target_class").groupBy("s1_class").agg(F.sum("_m").alias("_n"))
    more = found.pairs.filter("not has_a").join(enough.filter(F.col("_n") >= fewer_than), "s1_class", "left_anti")
    return Classes(sure.pairs.unionByName(more), found.probes, found.targets).dealt_members()
