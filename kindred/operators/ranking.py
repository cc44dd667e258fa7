"""Scores and top-K of candidates. [SM22, W2, W3, W5, W7, AG25, GR6, PF8, PF9]"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators import blocking


@dataclass(frozen=True)
class RankingConfig:
    """Weight of each evidence flag, bonus for each further flag, most candidates kept (0: all)."""

    weights: dict[str, float] = field(default_factory=lambda: {"a": 3.0, "b": 2.0, "c": 1.5})
    bonus: float = 0.0
    most: int = 25


#: Of candidate generation.
PRODUCTION = RankingConfig({"a": 3.0, "b": 2.0, "c": 1.5, "d": 1.0, "f": 1.5, "g": 2.0, "i": 2.0}, 0.5, 25)


def score(config: RankingConfig) -> Column:
    """Weights of the flags that are set, and the bonus for each after the first."""
    total = F.lit(0.0)
    for flag, weight in config.weights.items():
        total = total + F.col(f"has_{flag}").cast("int") * F.lit(weight)
    more = F.greatest(F.col("evidence_count") - 1, F.lit(0)) * F.lit(config.bonus)
    return total + (more if config.bonus > 0 else 0)


def rank(found: DataFrame, config: RankingConfig = PRODUCTION) -> DataFrame:
    """Adds score and rank, by score, then number of flags, then id; keeps the best. [W3]"""
    w = Window.partitionBy("s1_id").orderBy(F.desc("score"), F.desc("evidence_count"), "target_id")
    ranked = found.withColumn("score", score(config)).withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= config.most) if config.most > 0 else ranked


def rank_classes(found: blocking.Classes, config: RankingConfig = PRODUCTION) -> DataFrame:
    """rank() of the evidence of all members, without writing it out.

    Members of an S1's class have the same ranking. Of its target classes only the best `most`, each by its least id, can
    hold one of its best `most` targets, and of a class only its `most` least ids.
    """
    if config.most <= 0:
        return rank(found.members(), config)
    found = blocking.Classes(found.pairs.withColumn("score", score(config)), found.probes, found.targets)
    return best_members(found, ["score", "evidence_count"], config.most)


def best_members(found: blocking.Classes, by: list[str], most: int) -> DataFrame:
    """The best `most` targets of each S1 by these columns of pairs of classes, the greatest first, ties to the smaller id:
    s1_id, target_id, the columns of pairs, rank."""
    best = lambda *ids: F.row_number().over(Window.partitionBy("s1_class").orderBy(*map(F.desc, by), *ids))
    near = found.pairs.withColumn("_rn", best("target_class")).filter(F.col("_rn") <= most)
    place = F.row_number().over(Window.partitionBy("target_class").orderBy("target_id"))
    least = found.targets.withColumn("_at", place).filter(F.col("_at") <= most)
    rows = near.join(least, "target_class").withColumn("rank", best("target_id")).filter(F.col("rank") <= most)
    columns = [c for c in found.pairs.columns if c not in ("s1_class", "target_class")]
    return rows.join(found.probes, "s1_class").select("s1_id", "target_id", *columns, "rank")


def best_per_source(scored: DataFrame, by: str = "p", least: float | None = None) -> DataFrame:
    """The best target of each source for each S1, ties to the smaller id. [W2, AG25, GR6]"""
    rows = scored.withColumn("source", F.substring("target_id", 1, 2))
    if least is not None:
        rows = rows.filter(F.col(by) >= least)
    w = Window.partitionBy("s1_id", "source").orderBy(F.desc(by), "target_id")
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def multi_match(scored: DataFrame, least: float = 0.65, further: float = 0.85, by: str = "p") -> DataFrame:
    """The best of each source if it reaches `least`, further ones if they reach `further`. [W7]"""
    rows = scored.withColumn("source", F.substring("target_id", 1, 2))
    w = Window.partitionBy("s1_id", "source").orderBy(F.desc(by), "target_id")
    ok = ((F.col("_rn") == 1) & (F.col(by) >= least)) | ((F.col("_rn") > 1) & (F.col(by) >= further))
    return rows.withColumn("_rn", F.row_number().over(w)).filter(ok).drop("_rn")


def conflict_gate(scored: DataFrame, one: str, two: str, by: str = "p") -> DataFrame:
    """The probability becomes 0 where both values are there and differ. [PF9]"""
    known = (F.coalesce(one, F.lit("")) != "") & (F.coalesce(two, F.lit("")) != "")
    return scored.withColumn(by, F.when(known & (F.col(one) != F.col(two)), 0.0).otherwise(F.col(by)))


def prefilter(scored: DataFrame, least: float = 0.35, most: int = 200, by: str = "similarity") -> DataFrame:
    """Of each S1's pairs that reach `least` the best `most`. [SL4]"""
    w = Window.partitionBy("s1_id").orderBy(F.desc(by), "target_id")
    return scored.filter(F.col(by) >= least).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most).drop("_rn")
