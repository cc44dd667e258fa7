"""Evaluation. Pairs are (s1_id, target_id); scope has an s1_id for each entity evaluated, and its country.

[AG6-AG15, AG20-AG24, J20, SO3, SO4, EV1-EV3]
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.similarity import f_beta
from kindred.operators import keys as K
from kindred.operators import ranking
from kindred.operators.blocking import index_percentiles


def confusion(scope: DataFrame, truth: DataFrame, found: DataFrame) -> DataFrame:
    """scope with n_true, n_found and n_right of each entity."""
    t = truth.select("s1_id", "target_id", F.lit(1).alias("_t")).distinct()
    p = found.select("s1_id", "target_id", F.lit(1).alias("_p")).distinct()
    both = t.join(p, ["s1_id", "target_id"], "full")
    counts = both.groupBy("s1_id").agg(
        F.count("_t").alias("n_true"),
        F.count("_p").alias("n_found"),
        F.count_if(F.col("_t").isNotNull() & F.col("_p").isNotNull()).alias("n_right"),
    )
    return scope.join(counts, "s1_id", "left").fillna(0, ["n_true", "n_found", "n_right"])


def entity_scores(confused: DataFrame) -> DataFrame:
    """Adds precision, recall and f05: 1 where nothing is true and nothing found, 0 where only one is empty."""
    none = (F.col("n_true") == 0) & (F.col("n_found") == 0)
    p = F.when(none, 1.0).when(F.col("n_found") == 0, 0.0).otherwise(F.col("n_right") / F.col("n_found"))
    r = F.when(none, 1.0).when(F.col("n_true") == 0, 0.0).otherwise(F.col("n_right") / F.col("n_true"))
    return confused.withColumn("precision", p).withColumn("recall", r).withColumn("f05", f_beta(F.col("precision"), F.col("recall")))


def _mean(c: str) -> Column:
    return F.round(F.avg(c), 9).alias(c)


def macro(confused: DataFrame) -> DataFrame:
    """Means over entities. [AG11]"""
    return entity_scores(confused).agg(F.count("*").alias("entities"), _mean("precision"), _mean("recall"), _mean("f05"))


def macro_by_country(confused: DataFrame) -> DataFrame:
    """The same for each country and, with country null, for all. [AG12]"""
    scores = entity_scores(confused).rollup("country")
    return scores.agg(F.count("*").alias("entities"), _mean("precision"), _mean("recall"), _mean("f05"))


def micro(confused: DataFrame) -> DataFrame:
    """Pooled precision, recall, F0.5 and F1; accuracy over singletons and whole entities. [AG13]"""
    single = F.col("n_true") == 0
    sums = confused.agg(
        F.sum("n_right").alias("tp"),
        F.sum(F.col("n_found") - F.col("n_right")).alias("fp"),
        F.sum(F.col("n_true") - F.col("n_right")).alias("fn"),
        F.round(F.avg(F.when(single, (F.col("n_found") == 0).cast("double"))), 9).alias("singleton_accuracy"),
        F.round(
            F.avg(((F.col("n_found") == F.col("n_right")) & (F.col("n_true") == F.col("n_right"))).cast("double")), 9
        ).alias("exact_accuracy"),
    )
    p = F.when(F.col("tp") + F.col("fp") == 0, 0.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fp")))
    r = F.when(F.col("tp") + F.col("fn") == 0, 0.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fn")))
    out = sums.withColumn("precision", p).withColumn("recall", r)
    f05, f1 = f_beta(F.col("precision"), F.col("recall")), f_beta(F.col("precision"), F.col("recall"), 1.0)
    return out.withColumn("f05", f05).withColumn("f1", f1)


def threshold_sweep(scope: DataFrame, truth: DataFrame, scored: DataFrame, thresholds: list[float], by: str = "p") -> DataFrame:
    """Macro scores at each threshold, in one pass over the scored pairs. [AG14]"""
    grid = F.array(*map(F.lit, thresholds))
    every = scope.select("s1_id", F.explode(grid).alias("threshold"))
    above = F.filter(grid, lambda t: t <= F.col(by))
    hits = scored.select("s1_id", "target_id", F.explode(above).alias("threshold"))
    marked = hits.join(truth.select("s1_id", "target_id", F.lit(1).alias("_t")).distinct(), ["s1_id", "target_id"], "left")
    found = marked.groupBy("s1_id", "threshold").agg(F.count("*").alias("n_found"), F.count("_t").alias("n_right"))
    true = truth.distinct().groupBy("s1_id").agg(F.count("*").alias("n_true"))
    rows = every.join(found, ["s1_id", "threshold"], "left").join(true, "s1_id", "left")
    rows = entity_scores(rows.fillna(0, ["n_true", "n_found", "n_right"]))
    return rows.groupBy("threshold").agg(_mean("precision"), _mean("recall"), _mean("f05"))


def recall_at(scope: DataFrame, truth: DataFrame, ranked: DataFrame, cuts: list[int]) -> DataFrame:
    """For each cut: pairs recovered, entities recovered whole, candidates in all and at most, entities without any.
    [AG9, W5]"""
    grid = F.array(*map(F.lit, cuts))
    rows = scope.select("s1_id", F.explode(grid).alias("k"))
    within = F.filter(grid, lambda k: k >= F.col("rank"))
    marked = ranked.join(truth.select("s1_id", "target_id", F.lit(1).alias("_t")).distinct(), ["s1_id", "target_id"], "left")
    hits = marked.select("s1_id", "_t", F.explode(within).alias("k"))
    per = hits.groupBy("s1_id", "k").agg(F.count("*").alias("n_found"), F.count("_t").alias("n_right"))
    true = truth.distinct().groupBy("s1_id").agg(F.count("*").alias("n_true"))
    rows = rows.join(per, ["s1_id", "k"], "left").join(true, "s1_id", "left").fillna(0, ["n_found", "n_right", "n_true"])
    whole = (F.col("n_true") > 0) & (F.col("n_right") == F.col("n_true"))
    return rows.groupBy("k").agg(
        F.sum("n_true").alias("true_pairs"),
        F.sum("n_right").alias("recovered"),
        F.count_if(whole).alias("whole_entities"),
        F.sum("n_found").alias("candidates"),
        F.max("n_found").alias("most_candidates"),
        F.count_if(F.col("n_found") == 0).alias("without_candidates"),
    )


def evidence_breakdown(truth: DataFrame, found: DataFrame) -> DataFrame:
    """True pairs by which of A, B and C found them; pairs of other evidence alone are in none. [AG10]"""
    hits = found.join(truth, ["s1_id", "target_id"], "left_semi").filter("has_a or has_b or has_c")
    return hits.groupBy("has_a", "has_b", "has_c").agg(F.count("*").alias("pairs"))


def missed(truth: DataFrame, found: DataFrame) -> DataFrame:
    """[J20]"""
    return truth.join(found, ["s1_id", "target_id"], "left_anti")


def experimental_split(truth: DataFrame, found: DataFrame) -> DataFrame:
    """True pairs that A, B and C miss, by whether D and F find them. [AG20, SO5]"""
    base = found.filter("has_a or has_b or has_c")
    left = missed(truth, base).join(found.select("s1_id", "target_id", "has_d", "has_f"), ["s1_id", "target_id"], "left")
    left = left.fillna(False, ["has_d", "has_f"])
    return left.groupBy("has_d", "has_f").agg(F.count("*").alias("pairs"))


def candidate_volume(scope: DataFrame, found: DataFrame) -> DataFrame:
    """Distribution of candidates an entity, entities without any included. [AG6, AG7, SM20]"""
    return volume(scope, found.groupBy("s1_id").agg(F.count("*").alias("n")))


def volume(scope: DataFrame, counts: DataFrame) -> DataFrame:
    """candidate_volume of counts (s1_id, n)."""
    rows = scope.select("s1_id").join(counts, "s1_id", "left").fillna(0, ["n"])
    plain = rows.agg(
        F.count("*").alias("entities"),
        F.sum("n").alias("candidates"),
        F.round(F.avg("n"), 9).alias("mean"),
        F.max("n").alias("largest"),
        F.count_if(F.col("n") == 0).alias("without"),
        *[F.percentile("n", F.lit(q / 100)).cast("int").alias(f"linear_p{q}") for q in (50, 95, 99)],
    )
    by_index = index_percentiles(rows.withColumn("_g", F.lit(1)), ["_g"], "n", (0.5, 0.95, 0.99)).drop("_g")
    return plain.join(F.broadcast(by_index))


def per_source(found: DataFrame) -> DataFrame:
    """[AG8]"""
    return found.groupBy(F.substring("target_id", 1, 2).alias("source")).agg(F.count("*").alias("pairs"))


def singleton_candidates(scope: DataFrame, truth: DataFrame, found: DataFrame, most: int = 25) -> DataFrame:
    """Entities that nothing matches by the number of their candidates: none, up to most, more. [AG22]"""
    alone = scope.select("s1_id").join(truth, "s1_id", "left_anti")
    counts = found.groupBy("s1_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    bucket = F.when(n == 0, "none").when(n <= most, f"up to {most}").otherwise("more")
    return alone.join(counts, "s1_id", "left").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("entities"))


def truncation_loss(truth: DataFrame, ranked: DataFrame, most: int) -> DataFrame:
    """True pairs that ranking cuts off: found at all, and by which kind of evidence. [AG23, AG24]"""
    rows = truth.join(ranked, ["s1_id", "target_id"], "left")
    reason = (
        F.when(F.col("rank").isNull(), "not found")
        .when(F.col("rank") <= most, "kept")
        .when(F.col("has_a") | F.col("has_b") | F.col("has_c"), "cut, base evidence")
        .otherwise("cut, experimental evidence")
    )
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("pairs"))


def _exploded(values: dict[str, Column], name: str, value: str) -> Column:
    """An array of (name, value) for explode: one pass over a table for many configurations."""
    return F.explode(F.array(*[F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in values.items()]))


def bake_off(truth: DataFrame, found: DataFrame, configs: dict[str, ranking.RankingConfig], most: int = 25, promoted: int = 3) -> DataFrame:
    """Of each ranking the true pairs among the first `most` candidates, those of them that only experimental keys find,
    candidates, its place by true pairs (ties in the order given) and whether it is one of the `promoted`. [EV2, AG21]

    Evidence is read once; every configuration ranks a copy of its ids and flags.
    """
    base = F.col("has_a") | F.col("has_b") | F.col("has_c")
    marked = found.join(truth.select("s1_id", "target_id", F.lit(1).alias("_t")).distinct(), ["s1_id", "target_id"], "left")
    scores = {n: ranking.score(c) for n, c in configs.items()}
    rows = marked.select("s1_id", "target_id", "_t", "evidence_count", base.alias("_base"), _exploded(scores, "config", "score").alias("_c"))
    rows = rows.select("*", "_c.*").drop("_c")
    w = Window.partitionBy("config", "s1_id").orderBy(F.desc("score"), F.desc("evidence_count"), "target_id")
    kept = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most)
    out = kept.groupBy("config").agg(
        F.count("_t").alias("recovered"), F.count_if(F.col("_t").isNotNull() & ~F.col("_base")).alias("only_experimental"), F.count("*").alias("candidates")
    )
    order = F.array_position(F.array(*map(F.lit, configs)), F.col("config"))
    # A row for each configuration: the one window is over a handful of them.
    out = out.withColumn("place", F.row_number().over(Window.orderBy(F.desc("recovered"), order)))
    first = out.agg(F.max(F.when(order == 1, F.col("recovered"))).alias("_first"))
    out = out.join(F.broadcast(first)).withColumn("gain", F.col("recovered") - F.col("_first")).drop("_first")
    return out.withColumn("promoted", F.col("place") <= promoted)


def ablation(truth: DataFrame, s1: DataFrame, targets: DataFrame, experiments: dict[str, dict[str, int | None]]) -> DataFrame:
    """Candidate pairs, true ones among them and the gain in those on the first experiment, of each experiment: the keys it
    uses with their caps (None: none). [EV3]

    Keys are joined once, postings with their place in the key's list; an experiment takes hits within its caps.
    """
    names = tuple(sorted({k for keys in experiments.values() for k in keys}))
    w = Window.partitionBy("key_type", "key").orderBy("ord", "entity_id")
    posted = K.key_table(targets, names).dropDuplicates(["key_type", "key", "entity_id"]).withColumn("at", F.row_number().over(w))
    most = {k: max((keys[k] or 1 << 62) for keys in experiments.values() if k in keys) for k in names}
    posted = posted.filter(F.coalesce(*[F.when(F.col("key_type") == k, F.col("at") <= n) for k, n in most.items()]))
    left = K.key_table(s1, names).select("key_type", "key", F.col("entity_id").alias("s1_id")).distinct()
    hits = left.join(posted.select("key_type", "key", F.col("entity_id").alias("target_id"), "at"), ["key_type", "key"])
    best = hits.groupBy("s1_id", "target_id").agg(*[F.min(F.when(F.col("key_type") == k, F.col("at"))).alias(f"at_{k}") for k in names])

    def within(keys: dict[str, int | None]) -> Column:
        tests = [F.coalesce(F.col(f"at_{k}") <= (n or 1 << 62), F.lit(False)) for k, n in keys.items()]
        out = tests[0]
        for t in tests[1:]:
            out = out | t
        return out

    marked = best.join(truth.select("s1_id", "target_id", F.lit(1).alias("_t")).distinct(), ["s1_id", "target_id"], "left")
    rows = marked.select("_t", _exploded({n: within(keys) for n, keys in experiments.items()}, "experiment", "hit").alias("e"))
    out = rows.filter("e.hit").groupBy("e.experiment").agg(F.count("*").alias("pairs"), F.count("_t").alias("recovered"))
    first = out.agg(F.max(F.when(F.col("experiment") == next(iter(experiments)), F.col("recovered"))).alias("_first"))
    return out.join(F.broadcast(first)).withColumn("gain", F.col("recovered") - F.coalesce("_first", F.lit(0))).drop("_first")


def rule_grid(scope: DataFrame, pairs: DataFrame, truth: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, found, right, precision, recall and f05 of all entities pooled, the mean f05 over the entities of scope, and
    whether that is the greatest (ties to the first in alphabetical order), for each predicate over the same pairs, in one
    pass. [PF11, AG15]"""
    marked = pairs.join(truth.select("s1_id", "target_id", F.lit(1).alias("_t")).distinct(), ["s1_id", "target_id"], "left")
    hits = marked.select("s1_id", "_t", _exploded(rules, "rule", "hit").alias("r")).filter("r.hit")
    per = hits.groupBy("s1_id", "r.rule").agg(F.count("*").alias("n_found"), F.count("_t").alias("n_right"))
    return _grid(scope, per, truth, rules)


def rule_grid_of_counts(scope: DataFrame, n_found: DataFrame, true: DataFrame, pairs: DataFrame, truth: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule_grid where the pairs are not written out: from n_found (s1_id, rule, n_found), true (s1_id, s1_class, target_class,
    _m: true pairs of an S1 with a class of targets) and the pairs (s1_class, target_class and what rules ask for) of true."""
    hits = pairs.select("s1_class", "target_class", _exploded(rules, "rule", "hit").alias("r")).filter("r.hit")
    n_right = true.join(hits.select("s1_class", "target_class", "r.rule"), ["s1_class", "target_class"])
    n_right = n_right.groupBy("s1_id", "rule").agg(F.sum("_m").alias("n_right"))
    return _grid(scope, n_found.join(n_right, ["s1_id", "rule"], "left").fillna(0, ["n_right"]), truth, rules)


def _grid(scope: DataFrame, per: DataFrame, truth: DataFrame, rules: dict[str, Column]) -> DataFrame:
    true = truth.distinct().groupBy("s1_id").agg(F.count("*").alias("n_true"))
    every = scope.select("s1_id", F.explode(F.array(*map(F.lit, rules))).alias("rule"))
    rows = every.join(per, ["s1_id", "rule"], "left").join(true, "s1_id", "left").fillna(0, ["n_found", "n_right", "n_true"])
    out = entity_scores(rows).groupBy("rule").agg(
        F.sum("n_found").alias("found"), F.sum("n_right").alias("right"), F.sum("n_true").alias("n_true"), F.round(F.avg("f05"), 9).alias("macro_f05")
    )
    p = F.when(F.col("found") == 0, 0.0).otherwise(F.col("right") / F.col("found"))
    r = F.when(F.col("n_true") == 0, 0.0).otherwise(F.col("right") / F.col("n_true"))
    out = out.withColumn("precision", F.round(p, 9)).withColumn("recall", F.round(r, 9))
    out = out.withColumn("f05", F.round(f_beta(p, r), 9)).drop("n_true")
    best = out.agg(F.max_by("rule", F.struct("macro_f05", F.transform(F.split("rule", ""), lambda c: -F.ascii(c)))).alias("_best"))
    return out.join(F.broadcast(best)).withColumn("best", F.col("rule") == F.col("_best")).drop("_best")


def run_report(
    scope: DataFrame, truth: DataFrame, found: DataFrame, ranked: DataFrame, crossing: DataFrame, pairs: DataFrame | None = None
) -> DataFrame:
    """metric, value: what a run of candidate generation counts. [AG7, SK5]

    With pairs (one row, their number), found needs only those that are true, and crossing is a number as well.
    """
    marked = lambda df: df.select("s1_id", "target_id").distinct().join(truth.distinct(), ["s1_id", "target_id"], "left_semi")
    one = lambda df, name: df.agg(F.count("*").cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")
    number = lambda df, name: one(df, name) if pairs is None else df.select(F.lit(name).alias("metric"), F.col(df.columns[0]).cast("double").alias("value"))
    rows = [
        one(scope, "entities"),
        one(truth.distinct(), "true_pairs"),
        number(found if pairs is None else pairs, "pairs"),
        one(marked(found), "true_pairs_found"),
        one(marked(ranked), "true_pairs_kept"),
        one(ranked, "pairs_kept"),
        one(ranked.groupBy("s1_id", "target_id").count().filter("count > 1"), "pairs_twice"),
        one(ranked.filter(~F.col("target_id").rlike("^S[23]-")), "bad_targets"),
        one(ranked.join(scope, "s1_id", "left_anti"), "unknown_entities"),
        number(crossing, "pairs_across_countries"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def digest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows, digest: a checksum of a result that does not depend on the order of its rows, so that no task sees all of
    them: the sum of 32 bits of each row's md5. [SM21]"""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])
    bits = F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).alias("digest"))
