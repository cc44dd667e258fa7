"""New records as a stream against a static table of keys. [streaming extension]

A stream-static join without state: each record is answered from the targets alone, so no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators import blocking, keys, ranking


def postings(targets: DataFrame, names: tuple[str, ...] = keys.PRODUCTION) -> DataFrame:
    """The static side: write it once and read it for each start of the stream."""
    limits = {n: keys.KEYS[n].cap for n in names if keys.KEYS[n].cap}
    rows = blocking.capped(keys.key_table(targets, names), limits)
    return rows.select("key_type", "key", F.col("entity_id").alias("target_id"))


def candidates(stream: DataFrame, static: DataFrame, names: tuple[str, ...] = keys.PRODUCTION) -> DataFrame:
    """s1_id, target_id, key_type for each key a streamed record (entity_id, name, address, country, ord) shares."""
    left = keys.key_table(stream, names).select("key_type", "key", F.col("entity_id").alias("s1_id"))
    return left.join(static, ["key_type", "key"]).select("s1_id", "target_id", "key_type")


def rank_batch(hits: DataFrame, config: ranking.RankingConfig = ranking.PRODUCTION) -> DataFrame:
    """Rank the hits of one micro-batch (for foreachBatch), as the batch operator ranks them."""
    flags = [F.bool_or(F.col("key_type") == f).alias(f"has_{f}") for f in blocking.FLAGS]
    found = hits.groupBy("s1_id", "target_id").agg(*flags)
    count = sum((F.col(f"has_{f}").cast("int") for f in blocking.FLAGS[1:]), F.col("has_a").cast("int"))
    return ranking.rank(found.withColumn("evidence_count", count), config)
