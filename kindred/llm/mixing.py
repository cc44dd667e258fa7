"""Operator 4, mixing sources to target weights: Efraimidis-Spirakis sampling, in DataFrame functions only.

Each source gets a budget of words. A source whose budget exceeds its size is first taken whole, as often as it fits
(complete epochs); the rest of the budget is filled by documents in ascending order of an exponential key,
-ln(u) / quality: the order in which a weighted sample without replacement draws them. The document at which the
budget ends is cut there, so a source takes its target to the word.

The prefix sums that find the end run in two levels, since one source may hold most rows: keys are dealt to buckets of
about BUCKET rows in key order, bucket sums are summed up by source, then documents within a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm import common

WORD = "[^\\x20\\x09-\\x0D]+"
BUCKET = 4_000
SEED = 20_011


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """1 for texts whose mean word length is that of prose (3 to 12 characters), else 0.5."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(mean.between(3, 12), 1.0).otherwise(0.5)


def source_targets(sizes: DataFrame, weights: list[float], share: float, epochs: float) -> DataFrame:
    """Target words of each source: source, source_size, n_docs -> and target.

    sizes has a row a source. Sources in code-point order, null last, weigh as weights says, repeating; they share
    `share` times all words, no source above `epochs` times its own, what it can't take going to the others by weight.
    In closed form: a source is full if its limit a unit of weight is below the level at which the others fill up.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_i"), F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("_i", F.row_number().over(order) - 1).withColumn("_w", w.cast("double"))
    rows = rows.withColumn("_cap", epochs * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    up = Window.orderBy("_ratio", "_i")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumns(
        {
            "_caps": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_ws": F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
            "_budget": F.lit(share) * F.sum("source_size").over(everything),
        }
    )
    rows = rows.withColumn("_level", (F.col("_budget") - F.col("_caps")) / F.col("_ws"))
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_i", "_level"))).over(everything)
    rows = rows.withColumn("_at", level)
    target = F.when(F.col("_at").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_w") * F.col("_at._level"))
    )
    return rows.select(*sizes.columns, target.alias("target"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Words taken of each row: doc_id, source, size, source_size, target, taken; options as _mixed has them.

    docs: doc_id, source, text; other columns are ignored. A null text has size 0 and takes 0; null is a source of its
    own. Repeated rows count each: they share a key, and which of two equal rows is cut makes no difference.
    """
    return _mixed(docs, **options).drop("_tie")


def _mixed(
    docs: DataFrame,
    weights: list[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = SEED,
    size: Column | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """mix, and a hash of each row's text as _tie."""
    size = n_words(F.col("text")) if size is None else size
    base = docs.select("doc_id", "source", "text").withColumn("size", size)
    weight = quality(F.col("text"), F.col("size")) if weight is None else weight
    u = common.hash_uniform(F.col("doc_id"), seed=seed)
    keyed = base.withColumn("_key", -F.log(u) / weight).withColumn("_tie", F.xxhash64("text"))
    keyed = common.materialize(keyed.select("doc_id", "source", "size", "_key", "_tie"), "mix")
    sizes = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count("*").alias("n_docs"),
        # In whole millionths, so that the sum does not depend on its order.
        (F.sum((1e6 * F.col("_key")).cast("long")) / F.count("*") / 1e6 + 1e-6).alias("_mean_key"),
    )
    goals = source_targets(sizes, list(weights), share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("_epochs", whole.cast("long")).withColumn(
        "_rest", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long")
    )
    # 1 - exp(-key / mean) rises with the key and spreads over (0, 1), evenly where weights are equal.
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET))
    bucket = F.least(F.floor((1 - F.exp(-F.col("_key") / F.col("_mean_key"))) * buckets), buckets - 1).cast("long")
    rows = keyed.join(goals, keyed["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    rows = rows.withColumn("_bucket", bucket)
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    up = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(up), F.lit(0)).alias("_at")
    )
    placed = rows.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    within = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "_tie")
    ahead = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_at") - ahead))
    taken = (F.col("_epochs") * F.col("size") + part).cast("long").alias("taken")
    return placed.select("doc_id", "source", "size", "source_size", "target", taken, "_tie")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """docs as often as the mix takes them, same columns: a row taken 1.4 times is there whole, and cut to 0.4.

    A cut text keeps its first words, parted by single spaces, and n_chars (if there is one) follows it. A row of which
    nothing is taken goes. Rows that repeat id, source and text are written as copies of the one with the least hash.
    """
    key = ["doc_id", "source", "_tie"]
    totals = _mixed(docs, **options).groupBy(*key).agg(
        F.sum("taken").alias("_taken"), F.max("size").alias("_size"), F.count("*").alias("_rows")
    )
    totals = totals.filter("_taken > 0").select(*[F.col(c).alias(f"{c}_") for c in key], "_taken", "_size", "_rows")
    rows = docs.withColumn("_tie", F.xxhash64("text"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    rows = rows.join(totals, same)
    rows = rows.filter("_rows = 1").union(common.one_of_each(rows.filter("_rows > 1"), *key))
    whole, rest = F.expr("_taken div _size"), F.col("_taken") % F.col("_size")
    rows = rows.withColumn("_rest", rest).withColumn("_whole", whole)
    rows = rows.withColumn("_copy", F.explode(F.expr("sequence(1L, _whole + if(_rest > 0, 1L, 0L))")))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("_rest").cast("int")), " ")
    is_cut = F.col("_copy") > F.col("_whole")
    rows = rows.withColumn("text", F.when(is_cut, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        rows = rows.withColumn("n_chars", F.when(is_cut, length).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
