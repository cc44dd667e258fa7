"""Results of several matchers made one; recovery and audit passes. [J22-J24, SK3, SK4, SO6, SO7, PF12, PF13, ML9]

Matches are (s1_id, s2_id, s3_id); lists are arrays of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import text as T


def override_slots(first: DataFrame, second: DataFrame) -> DataFrame:
    """Slot by slot the first matcher's target, else the second's. [J22]"""
    b = second.select("s1_id", F.col("s2_id").alias("_2"), F.col("s3_id").alias("_3"))
    rows = first.join(b, "s1_id", "full")
    return rows.select("s1_id", F.coalesce("s2_id", "_2").alias("s2_id"), F.coalesce("s3_id", "_3").alias("s3_id"))


def override_entities(first: DataFrame, second: DataFrame) -> DataFrame:
    """All of the first matcher's targets of an entity if it has any, else all of the second's. [J23]"""
    b = second.select("s1_id", F.col("s2_id").alias("_2"), F.col("s3_id").alias("_3"))
    rows = first.join(b, "s1_id", "full")
    any_first = F.coalesce("s2_id", "s3_id").isNotNull()
    pick = lambda x, y: F.when(any_first, F.col(x)).otherwise(F.col(y)).alias(x)
    return rows.select("s1_id", pick("s2_id", "_2"), pick("s3_id", "_3"))


def recover(matches: DataFrame, scored: DataFrame, least: float = 0.75) -> DataFrame:
    """Empty slots filled by the best scored pair (s1_id, target_id, p) of that source at or above `least`. [J24, SO7]"""
    rows = scored.filter(F.col("p") >= least).withColumn("source", F.substring("target_id", 1, 2))
    best = rows.groupBy("s1_id").agg(
        *[
            F.min_by("target_id", F.when(F.col("source") == s, F.struct(-F.col("p"), F.col("target_id")))).alias(f"_{s}")
            for s in ("S2", "S3")
        ]
    )
    joined = matches.join(best, "s1_id", "left")
    filled = [F.coalesce(f"s{i}_id", F.when(F.col(f"_S{i}").startswith(f"S{i}"), F.col(f"_S{i}"))).alias(f"s{i}_id") for i in (2, 3)]
    return joined.select("s1_id", *filled)


def superset(matched: Column, candidates: Column) -> Column:
    """Matches, then candidates, each once. [SK3]"""
    return F.array_distinct(F.concat(matched, candidates))


def appended(matched: Column, candidates: Column) -> Column:
    """Candidates, then the matches they lack. [SK4]"""
    return F.concat(candidates, F.array_except(matched, candidates))


def suspects(pairs: DataFrame) -> DataFrame:
    """pairs (name, address, country 1 and 2) of one country with a reason where they need a second look. [PF4, PF12]"""
    same = F.lower(F.trim(T.present("country1"))) == F.lower(F.trim(T.present("country2")))
    state = [A.audit_state(f"address{i}", F.lower(F.trim(T.present(f"country{i}")))) for i in (1, 2)]
    words = [T.ascii_token_set(F.concat_ws(" ", T.present(f"name{i}"), T.present(f"address{i}"))) for i in (1, 2)]
    conflict = (state[0] != "") & (state[1] != "") & (state[0] != state[1])
    apart = (F.size(words[0]) > 0) & (F.size(words[1]) > 0) & (F.size(F.array_intersect(*words)) == 0)
    reason = F.when(conflict, "state_conflict").when(apart, "low_overlap")
    return pairs.filter(same).withColumn("reason", reason)


def audited(scored: DataFrame, state_least: float = 0.0, overlap_least: float = -1.0) -> DataFrame:
    """Pairs without a reason, and suspects whose rerank_score reaches the threshold of their reason. [PF13, ML9]"""
    least = F.when(F.col("reason") == "state_conflict", F.lit(state_least)).otherwise(F.lit(overlap_least))
    return scored.filter(F.col("reason").isNull() | (F.col("rerank_score") >= least))
