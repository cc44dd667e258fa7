"""Candidate generation: joins on keys, evidence, caps, cascades of tiers. [J1-J10, J15, J16, AG1-AG5, W1, W4, W6, PF14]"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import text as T
from kindred.functions import vocab
from kindred.operators import keys as K

FLAGS = ("a", "b", "c", "d", "f", "g", "i")
#: Members of a class that dealt_members gives one task.
PART = 512


def capped(postings: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Of each key only the first postings in read order, as many as its type's cap. [W1]

    A cap is part of the result, and bounds what a frequent key brings into the join.
    """
    cap = F.coalesce(*[F.when(F.col("key_type") == k, F.lit(n)) for k, n in caps.items()], F.lit(None).cast("int"))
    if not caps:
        return postings
    free, bound = postings.filter(cap.isNull()), postings.filter(cap.isNotNull()).dropDuplicates(["key_type", "key", "entity_id"])
    w = Window.partitionBy("key_type", "key").orderBy("ord", "entity_id")
    ranked = bound.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max(caps.values()))
    return free.unionByName(ranked.filter(F.col("_rn") <= cap).drop("_rn"))


@dataclass(frozen=True)
class Classes:
    """Evidence between classes of records that have the same postings, and so the same evidence with everything.

    pairs: s1_class, target_class, a flag for each evidence, evidence_count; probes: s1_class, s1_id; targets: target_class,
    target_id. A class is named by its least id.
    """

    pairs: DataFrame
    probes: DataFrame
    targets: DataFrame

    def members(self) -> DataFrame:
        """evidence() of all members."""
        flags = [c for c in self.pairs.columns if c not in ("s1_class", "target_class")]
        # A class travels as one list of its members, written out after both joins.
        left = self.probes.groupBy("s1_class").agg(F.collect_list("s1_id").alias("_s"))
        right = self.targets.groupBy("target_class").agg(F.collect_list("target_id").alias("_t"))
        rows = self.pairs.join(right, "target_class").join(left, "s1_class").select("_s", "_t", *flags)
        return rows.withColumn("s1_id", F.explode("_s")).withColumn("target_id", F.explode("_t")).select("s1_id", "target_id", *flags)

    def dealt_members(self) -> DataFrame:
        """s1_id, target_id of all members, where few pairs of classes stand for many pairs: classes go to tasks in parts of
        about PART members, so that no task writes out all pairs of a common name."""
        spark = self.pairs.sparkSession

        def parts(rows: DataFrame, name: str, id_col: str, out: str) -> DataFrame:
            n = rows.groupBy(name).agg(F.expr(f"(count(*) + {PART - 1}) div {PART}").alias("_n"))
            rows = rows.join(n, name).withColumn(f"{out}p", F.pmod(F.xxhash64(id_col), F.col("_n")))
            return rows.groupBy(name, f"{out}p").agg(F.collect_list(id_col).alias(out))

        left, right = parts(self.probes, "s1_class", "s1_id", "_s"), parts(self.targets, "target_class", "target_id", "_t")
        rows = self.pairs.select("s1_class", "target_class").join(right, "target_class").join(left, "s1_class")
        # A number of partitions that is given is not made smaller: lists are small, what they write out is not.
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(n, "s1_class", "_sp", "target_class", "_tp").select("_s", "_t")
        return rows.withColumn("s1_id", F.explode("_s")).withColumn("target_id", F.explode("_t")).select("s1_id", "target_id")

    def of(self, pairs: DataFrame) -> DataFrame:
        """evidence() of those of pairs (s1_id, target_id) that have some."""
        rows = pairs.select("s1_id", "target_id").distinct().join(self.probes, "s1_id").join(self.targets, "target_id")
        return rows.join(self.pairs, ["s1_class", "target_class"]).drop("s1_class", "target_class")

    def counts(self) -> DataFrame:
        """s1_id, n: how many targets each S1 that has any has evidence with."""
        sizes = self.targets.groupBy("target_class").agg(F.count("*").alias("m"))
        n = self.pairs.select("s1_class", "target_class").join(sizes, "target_class").groupBy("s1_class").agg(F.sum("m").alias("n"))
        return self.probes.join(n, "s1_class").select("s1_id", "n")


def alike(postings: DataFrame) -> DataFrame:
    """entity_id, class: entities with the same postings are of one class, which its least entity_id names."""
    name = F.concat("key_type", F.lit(K.SEPARATOR), "key")
    own = postings.groupBy("entity_id").agg(F.array_sort(F.collect_set(name)).alias("_keys"))
    heads = own.groupBy("_keys").agg(F.min("entity_id").alias("class"))
    return own.join(heads, "_keys").select("entity_id", "class")


def classes(
    probes: DataFrame,
    targets: DataFrame,
    names: tuple[str, ...] = K.PRODUCTION,
    caps: dict[str, int] | None = None,
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows,
) -> Classes:
    """evidence() before its members are written out: a name that many records share meets itself once for each different
    set of keys, not once for each pair of records. keep may write the tables that are read several times."""
    limits = {n: K.KEYS[n].cap for n in names if K.KEYS[n].cap} if caps is None else caps
    left = K.key_table(probes, names).select("key_type", "key", "entity_id")
    # Postings with and without a cap are two readings of one table.
    right = capped(keep("keys-target", K.key_table(targets, names)), limits).select("key_type", "key", "entity_id")
    sides = []
    for rows, side in ((left, "s1"), (right, "target")):
        rows = keep(f"postings-{side}", rows)
        of = keep(f"alike-{side}", alike(rows))
        heads = rows.join(of.filter(F.col("entity_id") == F.col("class")).select("entity_id"), "entity_id").distinct()
        heads = heads.select("key_type", "key", F.col("entity_id").alias(f"{side}_class"))
        sides.append((heads, of.select(F.col("class").alias(f"{side}_class"), F.col("entity_id").alias(f"{side}_id"))))
    # Flags travel as the bits of one number: there are many more hits than classes.
    bit = F.coalesce(*[F.when(F.col("key_type") == n, F.lit(1 << FLAGS.index(K.KEYS[n].flag))) for n in names if K.KEYS[n].flag], F.lit(0))
    hits = sides[0][0].join(sides[1][0].withColumn("_bit", bit), ["key_type", "key"])
    found = hits.groupBy("s1_class", "target_class").agg(F.bit_or("_bit").alias("_bits"))
    return Classes(flagged(found), sides[0][1], sides[1][1])


def flagged(found: DataFrame) -> DataFrame:
    """Pairs of classes with a column for each of FLAGS in place of _bits, and evidence_count."""
    flags = [(F.col("_bits").bitwiseAND(1 << i) != 0).alias(f"has_{f}") for i, f in enumerate(FLAGS)]
    return found.select("s1_class", "target_class", *flags, F.bit_count("_bits").alias("evidence_count"))


def evidence(
    probes: DataFrame, targets: DataFrame, names: tuple[str, ...] = K.PRODUCTION, caps: dict[str, int] | None = None
) -> DataFrame:
    """s1_id, target_id, a flag for each evidence, evidence_count: pairs that share a key of some kind. [J1-J3, AG2, AG3]"""
    return classes(probes, targets, names, caps).members()


def key_join(probes: DataFrame, targets: DataFrame, name: str, cap: int | None = None) -> DataFrame:
    """Pairs that share one key. [KA-KI with J1]"""
    left = K.key_table(probes, (name,)).select("key", F.col("entity_id").alias("s1_id"))
    right = capped(K.key_table(targets, (name,)), {name: cap} if cap else {})
    return left.join(right.select("key", F.col("entity_id").alias("target_id")), "key").select("s1_id", "target_id").distinct()


def reached(probes: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """target_id of the targets that share this key, without a cap, with some probe."""
    keys = K.key_table(probes, (name,)).select("key").distinct()
    return K.key_table(targets, (name,)).join(keys, "key", "left_semi").select(F.col("entity_id").alias("target_id"))


def key_stars(probes: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """u, v: of the pairs that share this key, without a cap, as many as connect the same: each key's probes with its least
    target, and its targets with its least probe."""
    left = K.key_table(probes, (name,)).select("key", F.col("entity_id").alias("u")).distinct()
    right = K.key_table(targets, (name,)).select("key", F.col("entity_id").alias("v")).distinct()
    first = left.join(right.groupBy("key").agg(F.min("v").alias("v")), "key").select("u", "v")
    return first.union(right.join(left.groupBy("key").agg(F.min("u").alias("u")), "key").select("u", "v"))


def posting_sizes(targets: DataFrame, names: tuple[str, ...] = K.PRODUCTION) -> DataFrame:
    rows = K.key_table(targets, names).dropDuplicates(["key_type", "key", "entity_id"])
    return rows.groupBy("key_type", "key").agg(F.count("*").alias("n"))


def index_percentiles(values: DataFrame, by: list[str], value: str, shares: tuple[float, ...]) -> DataFrame:
    """For each group sorted_values[floor(p * (n - 1))], as columns p50 and so on. [SM19]

    Values are counted first, so what a window sorts is distinct values, not rows.
    """
    counts = values.groupBy(*by, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by)
    upto = F.sum("_n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(w))
    at = {f"p{round(100 * p)}": F.floor(F.lit(p) * (F.col("_all") - 1)) for p in shares}
    return rows.groupBy(*by).agg(*[F.min(F.when(F.col("_upto") > i, F.col(value))).alias(c) for c, i in at.items()])


def posting_stats(targets: DataFrame, names: tuple[str, ...] = K.PRODUCTION) -> DataFrame:
    """For each key type: unique keys, postings, mean, percentiles by index, maximum, keys above sizes. [AG4, AG5]"""
    sizes = posting_sizes(targets, names)
    plain = sizes.groupBy("key_type").agg(
        F.count("*").alias("unique_keys"),
        F.sum("n").alias("postings"),
        F.round(F.avg("n"), 6).alias("mean"),
        F.max("n").alias("largest"),
        *[F.count_if(F.col("n") > m).alias(f"gt_{m}") for m in (25, 50, 100, 250, 500, 1000)],
    )
    return plain.join(index_percentiles(sizes, ["key_type"], "n", (0.5, 0.95, 0.99)), "key_type")


@dataclass(frozen=True)
class Tier:
    """A join of the cascade: its key, the most hits of a usable bucket, the most taken, whether only where none yet."""

    parts: tuple[str, ...]
    rare: int | None = None
    take: int | None = None
    last_resort: bool = False
    multi: bool = False


TIGHT = (
    Tier(("geo", "cn")),
    Tier(("cn",), rare=8),
    Tier(("geo", "w1")),
    Tier(("geo", "num")),
    Tier(("w1", "num")),
    Tier(("geo", "tri"), last_resort=True),
)
TIGHT_TWO = (
    Tier(("geo", "cn")),
    Tier(("geo", "cond")),
    Tier(("cond",), rare=8),
    Tier(("geo", "w1")),
    Tier(("geo", "word"), multi=True),
    Tier(("geo", "num")),
    Tier(("w1", "num")),
)


def _tier_rows(records: DataFrame, tiers: tuple[Tier, ...]) -> DataFrame:
    made = []
    for i, t in enumerate(tiers, 1):
        if t.multi:
            positions = F.posexplode("words").alias("pos", "word")
            rows = records.select("entity_id", "ord", "land", "geo", positions)
        else:
            rows = records.withColumn("pos", F.lit(0))
        made.append(rows.select("entity_id", "ord", F.lit(i).alias("tier"), "pos", K.tier_key(*t.parts).alias("key")))
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out.filter(F.col("key").isNotNull())


def cascade(probes: DataFrame, targets: DataFrame, tiers: tuple[Tier, ...], most: int) -> DataFrame:
    """s1_id, target_id, tier, place: tiers in order fill what is left of `most`; the first is never cut. [J6, J7, W4]

    probes and targets carry keys.tier_columns. Within a tier hits come in order of token, then of reading. Taking
    tiers in order until `most` are found is the same as ranking all hits by tier and cutting at `most`.
    """
    left = _tier_rows(probes, tiers).select("tier", "key", "pos", F.col("entity_id").alias("s1_id"))
    right = _tier_rows(targets, tiers).select("tier", "key", F.col("entity_id").alias("target_id"), "ord").distinct()
    rare = {i: t.rare for i, t in enumerate(tiers, 1) if t.rare}
    if rare:
        size = F.count("*").over(Window.partitionBy("tier", "key"))
        limit = F.coalesce(*[F.when(F.col("tier") == i, F.lit(n)) for i, n in rare.items()], F.lit(1 << 30))
        common = right.filter(F.col("tier").isin(list(rare))).withColumn("_n", size).filter(F.col("_n") <= limit).drop("_n")
        right = right.filter(~F.col("tier").isin(list(rare))).unionByName(common)
    hits = left.join(right, ["tier", "key"])
    first = hits.groupBy("s1_id", "target_id").agg(F.min(F.struct("tier", "pos", "ord")).alias("h"))
    rows = first.select("s1_id", "target_id", "h.tier", "h.pos", "h.ord")
    w = Window.partitionBy("s1_id").orderBy("tier", "pos", "ord", "target_id")
    rows = rows.withColumn("place", F.row_number().over(w))
    resort = [i for i, t in enumerate(tiers, 1) if t.last_resort]
    best = F.min("tier").over(Window.partitionBy("s1_id"))
    ok = (F.col("tier") == 1) | (F.col("place") <= most)
    if resort:
        rows = rows.withColumn("_best", best)
        ok = ok & (~F.col("tier").isin(resort) | (F.col("_best") == F.col("tier")))
    return rows.filter(ok).select("s1_id", "target_id", "tier", "place")


def sliced_union(probes: DataFrame, targets: DataFrame, slices: dict[tuple[str, ...], int]) -> DataFrame:
    """Union over keys, of each key only its first postings. [J9, J10]"""
    tiers = tuple(Tier(parts) for parts in slices)
    right = _tier_rows(targets, tiers).select("tier", "key", "entity_id", "ord").distinct()
    w = Window.partitionBy("tier", "key").orderBy("ord", "entity_id")
    limit = F.coalesce(*[F.when(F.col("tier") == i, F.lit(n)) for i, n in enumerate(slices.values(), 1)])
    most = max(slices.values())
    right = right.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most).filter(F.col("_rn") <= limit)
    left = _tier_rows(probes, tiers).select("tier", "key", F.col("entity_id").alias("s1_id"))
    return left.join(right, ["tier", "key"]).select("s1_id", F.col("entity_id").alias("target_id")).distinct()


def exact_name_matches(probes: DataFrame, targets: DataFrame, name: Column | None = None) -> DataFrame:
    """s1_id, matched_entity_ids of all records of the same country and name, in read order; all S1 are there. [J4, J21]"""
    key = K.key_of(K.country_of(), T.normalize_name("name") if name is None else name)
    left = probes.select(F.col("entity_id").alias("s1_id"), key.alias("key"))
    right = targets.select("entity_id", "ord", key.alias("key")).filter(F.col("key").isNotNull())
    hits = left.join(right, "key", "left")
    listed = F.sort_array(F.collect_set(F.when(F.col("entity_id").isNotNull(), F.struct("ord", "entity_id"))))
    found = hits.groupBy("s1_id").agg(listed.alias("hits"))
    return found.select("s1_id", F.array_join(F.transform("hits", lambda h: h["entity_id"]), ",").alias("matched_entity_ids"))


def rare_tokens(records: DataFrame, tokens: Column, least: int, most: int) -> DataFrame:
    """entity_id, country, token for tokens that `least` to `most` records have. [AG17, PF15]"""
    rows = records.select("entity_id", "ord", "country", F.explode(F.array_distinct(tokens)).alias("token"))
    sizes = rows.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df").between(least, most))
    return rows.join(sizes, "token")


def token_join(probes: DataFrame, targets: DataFrame, tokens: Column, least: int = 1, most: int = 5000) -> DataFrame:
    """s1_id, target_id, shared: pairs of one country by the number of tokens they share, of targets' tokens of bounded
    frequency. [J15, J16]"""
    right = rare_tokens(targets, tokens, least, most).select("token", "country", F.col("entity_id").alias("target_id"))
    left = probes.select(F.col("entity_id").alias("s1_id"), "country", F.explode(F.array_distinct(tokens)).alias("token"))
    return left.join(right, ["token", "country"]).groupBy("s1_id", "target_id").agg(F.count("*").alias("shared"))


def three_key_union(s1: DataFrame, targets: DataFrame, most: int = 25) -> DataFrame:
    """s1_id, target_id of records of one country that share the name, its first four letters and the numbers of the
    address, or the address's first number and word; of each S1 the first `most` by id. [J5]"""
    name = T.clean_name("name", vocab.SUFFIXES_BLOCKING)
    numbers = A.number_set_key("address")
    both = F.when((name != "") & (numbers != ""), F.concat_ws("|", T.prefix(name, 4), numbers))
    made = {"a": name, "b": both, "c": A.loose_anchor("address")}
    key = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.concat_ws("|", "country", k).alias("key"), k.isNotNull().alias("ok")) for n, k in made.items()]))
    side = lambda df, i: df.filter("country is not null").select(F.col("entity_id").alias(i), key.alias("k")).filter("k.ok").select(i, "k.kind", "k.key")
    found = side(s1, "s1_id").join(side(targets, "target_id"), ["kind", "key"]).select("s1_id", "target_id").distinct()
    w = Window.partitionBy("s1_id").orderBy("target_id")
    return found.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most).drop("_rn")
