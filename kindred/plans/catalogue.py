"""The queries over the driver's tables, and the SQL that says the same.

Records are those of plans.entities; keys have their own caps.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import anchors as N
from kindred.functions import features as FV
from kindred.functions import similarity as S
from kindred.functions import text as T
from kindred.functions import vocab
from kindred.operators import best_pairs, blocking, failures, fusion, graph, keys, knn, learning, least_pairs, metrics, multilingual, ranking, sampling, validate
from kindred.plans import entities as E
from kindred.plans import oracle as O
from kindred.plans import presets
from kindred.sources import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
CAPS = {k.name: k.cap for k in keys.KEYS.values() if k.cap}
R33 = ranking.PRODUCTION


def query(name: str, sql: str | None = None):
    def register(f):
        @functools.wraps(f)
        def run(spark, d):
            with E.staging():
                return f(spark, d)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


def _with(body: str) -> str:
    return f"WITH {O.RECORDS}, {O.PARTS} {body}"


# -- scalars ---------------------------------------------------------------------------------------------------------


@query("normalize_name_documents", _with("SELECT entity_id, nn AS normalized FROM parts"))
def normalize_name_documents(spark, d):
    return E.records(spark, d).select("entity_id", T.normalize_name("name").alias("normalized"))


_LISTS = {
    "baseline": vocab.SUFFIXES_BASELINE,
    "blocking": vocab.SUFFIXES_BLOCKING,
    "multilingual": vocab.SUFFIXES_MULTILINGUAL,
    "tight": vocab.SUFFIXES_TIGHT,
    "pipeline": vocab.SUFFIXES_PIPELINE,
    "short": vocab.SUFFIXES_SHORT,
}


@query(
    "clean_name_variants",
    f"WITH {O.RECORDS} SELECT entity_id, " + ", ".join(f"{O.clean_name('name', v)} AS {k}" for k, v in _LISTS.items()) + " FROM rec",
)
def clean_name_variants(spark, d):
    return E.records(spark, d).select("entity_id", *[T.clean_name("name", v).alias(k) for k, v in _LISTS.items()])


@query(
    "address_parts",
    _with(r"""SELECT entity_id, array_to_string(nums, '_') AS numbers,
  CASE WHEN len(nums) > 0 AND len(alpha) > 0 THEN nums[1] || '_' || alpha[1] ELSE '' END AS anchor,
  array_to_string(list_sort(list_distinct(regexp_extract_all(address, '\d+'))), '_') AS number_set,
  regexp_extract(address, '\b\d+\b') AS first_number,
  array_to_string(street[1:2], ' ') AS street, array_to_string(list_sort(longest), ' ') AS pair FROM parts"""),
)
def address_parts(spark, d):
    return E.records(spark, d).select(
        "entity_id",
        A.address_numbers("address").alias("numbers"),
        A.address_anchor("address").alias("anchor"),
        A.number_set_key("address").alias("number_set"),
        A.first_number("address").alias("first_number"),
        F.array_join(A.street_tokens("address"), " ").alias("street"),
        F.array_join(A.address_pair("address"), " ").alias("pair"),
    )


@query(
    "significant_tokens",
    _with(f"""SELECT entity_id, array_to_string(sig, ' ') AS tokens, sig[1] AS first, ({O.by_length("sig")})[1] AS longest FROM parts"""),
)
def significant_tokens(spark, d):
    sig = T.significant_tokens("name")
    return E.records(spark, d).select(
        "entity_id",
        F.array_join(sig, " ").alias("tokens"),
        T.first_token(sig).alias("first"),
        T.longest_token(sig).alias("longest"),
    )


@query(
    "page_domains",
    r"""SELECT page_id, list_filter(list_transform(regexp_extract_all(url, '(?i)\b(?:https?://)?(?:www\.)?([a-zA-Z0-9][-a-zA-Z0-9]*\.[a-zA-Z]{2,}(?:\.[a-zA-Z]{2,})?)\b', 1), lambda h: lower(h)), lambda h: length(h) > 4)[1] AS domain FROM pages""",
)
def page_domains(spark, d):
    rows = E.table(spark, d, "pages")
    return rows.select("page_id", N.anchors("url", F.lit(""), F.lit("us"))["DOMAIN"].alias("domain"))


# -- keys and candidates ---------------------------------------------------------------------------------------------


def _key_query(name: str) -> None:
    cap = {name: CAPS[name]} if name in CAPS else {}
    sql = f"""WITH {O.RECORDS}, {O.PARTS}, {O.key_table((name,))}, {O.postings(cap)}
SELECT DISTINCT s.entity_id AS s1_id, p.entity_id AS target_id FROM keyed s JOIN posted p USING (key_type, key) WHERE s.source = 'S1'"""
    query(f"key_{name}_join", sql)(lambda spark, d: blocking.key_join(*E.sides(spark, d), name, CAPS.get(name)))


for _k in keys.KEYS:
    _key_query(_k)


_CAPS = {k: v for k, v in CAPS.items() if k != "h"}


def _keep(spark):
    return lambda name, rows: scratch.cached(spark, scratch.scratch_path(spark, name), lambda: rows)


def _unwritten(spark, d, names=keys.PRODUCTION, caps=_CAPS) -> blocking.Classes:
    return blocking.classes(*E.sides(spark, d), names, caps, _keep(spark))


def _classes(spark, d, names=keys.PRODUCTION, caps=_CAPS) -> blocking.Classes:
    """For queries that need no list of all pairs, or write it out once."""
    found = _unwritten(spark, d, names, caps)
    return blocking.Classes(E.staged(f"classes:{d}", lambda: found.pairs), found.probes, found.targets)


def _evidence(spark, d):
    return E.staged(f"evidence:{d}", lambda: _unwritten(spark, d).members())


def _ranked(spark, d):
    return E.staged(f"evidence:ranked:{d}", lambda: ranking.rank_classes(best_pairs.classes(*E.sides(spark, d), R33, caps=_CAPS, keep=_keep(spark))))


_EV = O.evidence(keys.PRODUCTION, _CAPS)
_RK = O.ranked(keys.PRODUCTION, _CAPS, R33.weights, R33.bonus)


@query("evidence_union", f"{_EV} SELECT * FROM ev")
def evidence_union(spark, d):
    return _classes(spark, d).members()


@query("evidence_ranked_top25", f"{_RK} SELECT * FROM rk WHERE rank <= 25")
def evidence_ranked_top25(spark, d):
    return _ranked(spark, d)


@query("posting_cap", f"WITH {O.RECORDS}, {O.PARTS}, {O.key_table(keys.PRODUCTION)}, {O.postings(_CAPS)} SELECT key_type, replace(key, '|', ' ') AS key, entity_id FROM posted")
def posting_cap(spark, d):
    rows = blocking.capped(keys.key_table(E.sides(spark, d)[1]), _CAPS).distinct()
    return rows.select("key_type", F.translate("key", keys.SEPARATOR, " ").alias("key"), "entity_id")


_PCT = {q: f"list_sort(list(n))[floor({q / 100} * (count(*) - 1))::INT + 1]" for q in (50, 95, 99)}


@query(
    "posting_stats",
    f"""WITH {O.RECORDS}, {O.PARTS}, {O.key_table(keys.PRODUCTION)},
sizes AS (SELECT key_type, key, count(*) AS n FROM keyed WHERE source <> 'S1' GROUP BY 1, 2)
SELECT key_type, count(*) AS unique_keys, sum(n)::BIGINT AS postings, round(avg(n), 6) AS mean, max(n) AS largest,
  {", ".join(f"count(*) FILTER (n > {m}) AS gt_{m}" for m in (25, 50, 100, 250, 500, 1000))},
  {", ".join(f"{x} AS p{q}" for q, x in _PCT.items())} FROM sizes GROUP BY 1""",
)
def posting_stats(spark, d):
    return blocking.posting_stats(E.sides(spark, d)[1])


@query(
    "exact_name_baseline",
    _with("""SELECT s.entity_id AS s1_id, coalesce(string_agg(DISTINCT t.entity_id, ',' ORDER BY t.entity_id), '') AS targets, count(DISTINCT t.entity_id) AS n
  FROM parts s LEFT JOIN parts t ON t.source <> 'S1' AND s.country = t.country AND s.nn = t.nn AND s.nn <> '' WHERE s.source = 'S1' GROUP BY 1"""),
)
def exact_name_baseline(spark, d):
    rows = blocking.exact_name_matches(*E.sides(spark, d))
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    return rows.select("s1_id", F.array_join(F.array_sort(ids), ",").alias("targets"), F.size(ids).cast("long").alias("n"))


def _tiered(spark, d, clean=vocab.SUFFIXES_TIGHT):
    options = {"india": E.PLACES_INDIA, "france": E.PLACES_FRANCE}
    return [keys.tier_columns(E.landed(x), T.clean_name("name", clean), **options) for x in E.sides(spark, d)]


def _sql_tiers(tiers) -> list[dict]:
    return [{"parts": t.parts, "rare": t.rare, "last_resort": t.last_resort, "multi": t.multi} for t in tiers]


@query("tiered_cascade_v1", O.cascade(_sql_tiers(blocking.TIGHT), 10, vocab.SUFFIXES_TIGHT))
def tiered_cascade_v1(spark, d):
    return blocking.cascade(*_tiered(spark, d), blocking.TIGHT, 10)


@query("tiered_cascade_v2", O.cascade(_sql_tiers(blocking.TIGHT_TWO), 8, vocab.SUFFIXES_TIGHT))
def tiered_cascade_v2(spark, d):
    return blocking.cascade(*_tiered(spark, d), blocking.TIGHT_TWO, 8)


_POSTAL = r"""CASE land WHEN 'india' THEN regexp_extract_all(address, '\b[1-9][0-9]{5}\b')[-1] WHEN 'france' THEN regexp_extract_all(address, '\b(?:0[1-9]|[1-8][0-9]|9[0-8])[0-9]{3}\b')[-1]
  WHEN 'us' THEN left(regexp_extract_all(address, '\b[0-9]{5}(?:-[0-9]{4})?\b')[-1], 5) END"""
_SLICED = " UNION ALL ".join(
    f"SELECT {i} AS tier, {n} AS lim, entity_id, source, ord, land || '|' || {' || chr(124) || '.join(parts)} AS key FROM tq WHERE "
    + " AND ".join(f"{p} <> ''" for p in parts)
    for i, (parts, n) in enumerate(presets.ANCHORED_SLICES.items())
)


@query(
    "sliced_union",
    f"""WITH {O.RECORDS}, {O.tier_parts(vocab.SUFFIXES_TIGHT)}, tq AS (SELECT *, {_POSTAL} AS postal FROM tp), k AS ({_SLICED}),
r AS (SELECT *, row_number() OVER (PARTITION BY tier, key ORDER BY ord, entity_id) AS rn FROM k WHERE source <> 'S1')
SELECT DISTINCT s.entity_id AS s1_id, r.entity_id AS target_id FROM k s JOIN r USING (tier, key) WHERE s.source = 'S1' AND rn <= r.lim""",
)
def sliced_union(spark, d):
    return blocking.sliced_union(*_tiered(spark, d), presets.ANCHORED_SLICES)


_TOKENS = rf"""list_distinct(list_filter(regexp_extract_all(lower(address), '[\p{{L}}\p{{N}}_]+'), lambda t: length(t) >= 2 AND NOT list_contains({O.words(vocab.ADDRESS_TOKEN_STOPS)}, t)))"""


def _token_join_sql(lo: int, hi: int) -> str:
    return f"""WITH {O.RECORDS}, tok AS (SELECT entity_id, source, country, unnest({_TOKENS}) AS token FROM rec),
df AS (SELECT token FROM tok WHERE source <> 'S1' GROUP BY 1 HAVING count(*) BETWEEN {lo} AND {hi})
SELECT s.entity_id AS s1_id, t.entity_id AS target_id, count(*) AS shared FROM tok s JOIN tok t USING (token, country) JOIN df USING (token)
WHERE s.source = 'S1' AND t.source <> 'S1' GROUP BY 1, 2"""


@query("token_overlap_join", _token_join_sql(1, 50))
def token_overlap_join(spark, d):
    return blocking.token_join(*E.sides(spark, d), A.address_tokens("address"), 1, 50)


@query("rare_token_join", _token_join_sql(2, 6))
def rare_token_join(spark, d):
    return blocking.token_join(*E.sides(spark, d), A.address_tokens("address"), 2, 6)


@query("token_frequency", f"WITH {O.RECORDS}, tok AS (SELECT unnest({_TOKENS}) AS token FROM rec) SELECT token, count(*) AS df FROM tok GROUP BY 1")
def token_frequency(spark, d):
    rows = E.records(spark, d).select(F.explode(A.address_tokens("address")).alias("token"))
    return rows.groupBy("token").agg(F.count("*").alias("df"))


# -- similarity and features -----------------------------------------------------------------------------------------


def _pairs(spark, d):
    """Candidate pairs by first significant word, with both records."""
    s1, targets = E.sides(spark, d)
    side = lambda df, i, key: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{c}{i}") for c in ("name", "address", "country")])
    found = blocking.key_join(s1, targets, "d", CAPS["d"])
    return found.join(side(s1, 1, "s1_id"), "s1_id").join(side(targets, 2, "target_id"), "target_id")


_PAIRS_SQL = f"""WITH {O.RECORDS}, {O.PARTS}, {O.key_table(("d",))}, {O.postings({"d": CAPS["d"]})},
pr AS (SELECT DISTINCT s.entity_id AS s1_id, p.entity_id AS target_id FROM keyed s JOIN posted p USING (key_type, key) WHERE s.source = 'S1'),
pairs AS (SELECT pr.*, a.name AS name1, b.name AS name2, a.nn AS n1, b.nn AS n2, a.address AS address1, b.address AS address2
  FROM pr JOIN parts a ON a.entity_id = s1_id JOIN parts b ON b.entity_id = target_id)"""


@query("jaro_winkler_pairs", f"{_PAIRS_SQL} SELECT s1_id, target_id, round(100 * jaro_winkler_similarity(regexp_replace(n1, '[^\\x00-\\x7F]', '?', 'g'), regexp_replace(n2, '[^\\x00-\\x7F]', '?', 'g')), 6) AS similarity FROM pairs")
def jaro_winkler_pairs(spark, d):
    rows = _pairs(spark, d)
    # DuckDB compares bytes; letters of more than one byte are marked alike on both sides.
    both = [F.regexp_replace(T.normalize_name(c), "[^\\x00-\\x7F]", "?") for c in ("name1", "name2")]
    return rows.select("s1_id", "target_id", F.round(S.jaro_winkler_column(*both), 6).alias("similarity"))


def _ft(x: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower({x}), '[a-z0-9]+'), lambda t: NOT list_contains({O.words(vocab.FEATURE_STOP_WORDS)}, t)))"


@query(
    "address_jaccard",
    f"""{_PAIRS_SQL}, t AS (SELECT s1_id, target_id, {_ft("address1")} AS a, {_ft("address2")} AS b FROM pairs),
o AS (SELECT *, len(list_intersect(a, b)) AS shared FROM t)
SELECT s1_id, target_id, shared::INT AS shared, CASE WHEN len(a) + len(b) - shared = 0 THEN 0.0 ELSE round(100.0 * shared / (len(a) + len(b) - shared), 6) END::DOUBLE AS jaccard FROM o""",
)
def address_jaccard(spark, d):
    a, b = A.feature_tokens("address1"), A.feature_tokens("address2")
    return _pairs(spark, d).select("s1_id", "target_id", S.overlap(a, b).alias("shared"), F.round(S.jaccard_percent(a, b), 6).alias("jaccard"))


_NATIVE = ["length_diff", "word_diff", "address_overlap", "address_jaccard", "condensed_match", "first_word_match", "number_match", "number_conflict"]


@query(
    "features_native",
    rf"""{_PAIRS_SQL}, t AS (SELECT *, {_ft("address1")} AS a, {_ft("address2")} AS b,
  list_filter(regexp_extract_all(address1, '\b\d+\b'), lambda x: length(x) <= 5)[1] AS d1, list_filter(regexp_extract_all(address2, '\b\d+\b'), lambda x: length(x) <= 5)[1] AS d2 FROM pairs),
o AS (SELECT *, len(list_intersect(a, b)) AS shared FROM t)
SELECT s1_id, target_id, abs(length(name1) - length(name2))::DOUBLE AS length_diff, abs(len({O.tokens("name1")}) - len({O.tokens("name2")}))::DOUBLE AS word_diff,
  shared::DOUBLE AS address_overlap, CASE WHEN len(a) + len(b) - shared = 0 THEN 0.0 ELSE round(100.0 * shared / (len(a) + len(b) - shared), 6) END::DOUBLE AS address_jaccard,
  (name1 <> '' AND replace(name1, ' ', '') = replace(name2, ' ', ''))::INT::DOUBLE AS condensed_match,
  (name1 <> '' AND split_part(name1, ' ', 1) = split_part(name2, ' ', 1))::INT::DOUBLE AS first_word_match,
  coalesce(d1 = d2, FALSE)::INT::DOUBLE AS number_match, coalesce(d1 <> d2, FALSE)::INT::DOUBLE AS number_conflict FROM o""",
)
def features_native(spark, d):
    """What of the eighteen features SQL can say."""
    rows = FV.pair_features(_pairs(spark, d)).withColumn("address_jaccard", F.round("address_jaccard", 6))
    return rows.select("s1_id", "target_id", *_NATIVE)


def _feature_query(name: str, which: list[str]) -> None:
    query(name)(lambda spark, d: FV.pair_features(_pairs(spark, d), which).select("s1_id", "target_id", *which))


_feature_query("features_18", FV.EIGHTEEN)


@query("pair_diagnostics")
def pair_diagnostics(spark, d):
    return FV.diagnostics(_pairs(spark, d))


# -- vectors ---------------------------------------------------------------------------------------------------------


@query(
    "cosine_knn",
    """WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, id)::INT AS rank FROM s)
SELECT query_id, id, rank, round(sim, 9) AS similarity FROM r WHERE rank <= 5""",
)
def cosine_knn(spark, d):
    rows = E.table(spark, d, "embeddings")
    return knn.similar_pairs(rows, rows, "label", k=5).withColumn("similarity", F.round("similarity", 9))


@query(
    "cosine_threshold",
    """SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS similarity
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.8""",
)
def cosine_threshold(spark, d):
    rows = E.table(spark, d, "embeddings")
    return knn.similar_pairs(rows, rows, "label", least=0.8).withColumn("similarity", F.round("similarity", 9))


# -- evaluation ------------------------------------------------------------------------------------------------------


def _found(spark, d):
    return _ranked(spark, d).filter("rank <= 2").select("s1_id", "target_id", "score")


def _confused(spark, d):
    scope = E.sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"), "country")
    return metrics.confusion(scope, E.truth(spark, d), _found(spark, d))


_CONF = f"{_RK}, {O.confusion('SELECT s1_id, target_id FROM rk WHERE rank <= 2')}"
_MEANS = "round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall, round(avg(f05), 9) AS f05"


@query("macro_f05", f"{_CONF} SELECT count(*) AS entities, {_MEANS} FROM scores")
def macro_f05(spark, d):
    return metrics.macro(_confused(spark, d))


@query("macro_f05_by_country", f"{_CONF} SELECT country, count(*) AS entities, {_MEANS} FROM scores GROUP BY ROLLUP (country)")
def macro_f05_by_country(spark, d):
    return metrics.macro_by_country(_confused(spark, d))


@query(
    "micro_scores",
    f"""{_CONF}, m AS (SELECT sum(n_right)::BIGINT AS tp, sum(n_found - n_right)::BIGINT AS fp, sum(n_true - n_right)::BIGINT AS fn,
  round(avg(CASE WHEN n_true = 0 THEN (n_found = 0)::INT END), 9) AS singleton_accuracy,
  round(avg((n_found = n_right AND n_true = n_right)::INT), 9) AS exact_accuracy FROM conf),
q AS (SELECT *, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM m)
SELECT tp, fp, fn, singleton_accuracy, exact_accuracy, round(p, 9) AS precision, round(r, 9) AS recall, round(1.25 * p * r / (0.25 * p + r), 9) AS f05, round(2 * p * r / (p + r), 9) AS f1 FROM q""",
)
def micro_scores(spark, d):
    rows = metrics.micro(_confused(spark, d))
    return rows.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f05", "f1")})


@query(
    "threshold_sweep",
    f"""{_RK}, {O.TRUTH}, {O.SCOPE}, grid AS (SELECT unnest([2.0, 4.0, 6.0, 8.0]::DOUBLE[]) AS threshold),
f AS (SELECT s1_id, threshold, count(*) AS n_found, count(t.target_id) AS n_right FROM rk JOIN grid ON score >= threshold
  LEFT JOIN truth t USING (s1_id, target_id) WHERE rank <= 25 GROUP BY 1, 2),
conf AS (SELECT s.s1_id, g.threshold, coalesce(n_found, 0) AS n_found, coalesce(n_right, 0) AS n_right, coalesce(t.n, 0) AS n_true
  FROM scope s CROSS JOIN grid g LEFT JOIN f ON f.s1_id = s.s1_id AND f.threshold = g.threshold
  LEFT JOIN (SELECT s1_id, count(*) AS n FROM truth GROUP BY 1) t ON t.s1_id = s.s1_id),
pr AS (SELECT *, CASE WHEN n_true = 0 AND n_found = 0 THEN 1.0 WHEN n_found = 0 THEN 0.0 ELSE n_right / n_found END::DOUBLE AS precision,
  CASE WHEN n_true = 0 AND n_found = 0 THEN 1.0 WHEN n_true = 0 THEN 0.0 ELSE n_right / n_true END::DOUBLE AS recall FROM conf),
scores AS (SELECT *, {O.F05} AS f05 FROM pr) SELECT threshold, {_MEANS} FROM scores GROUP BY 1""",
)
def threshold_sweep(spark, d):
    scope = E.sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"))
    return metrics.threshold_sweep(scope, E.truth(spark, d), _ranked(spark, d), [2.0, 4.0, 6.0, 8.0], by="score")


@query(
    "recall_at_k",
    f"""{_RK}, {O.TRUTH}, {O.SCOPE}, grid AS (SELECT unnest([1, 5, 10, 15, 20, 25]) AS k),
per AS (SELECT s.s1_id, g.k, count(r.target_id) AS n_found, count(t.target_id) AS n_right FROM scope s CROSS JOIN grid g
  LEFT JOIN rk r ON r.s1_id = s.s1_id AND r.rank <= g.k LEFT JOIN truth t ON t.s1_id = r.s1_id AND t.target_id = r.target_id GROUP BY 1, 2),
full_ AS (SELECT per.*, coalesce(t.n, 0) AS n_true FROM per LEFT JOIN (SELECT s1_id, count(*) AS n FROM truth GROUP BY 1) t USING (s1_id))
SELECT k::INT AS k, sum(n_true)::BIGINT AS true_pairs, sum(n_right)::BIGINT AS recovered, count(*) FILTER (n_true > 0 AND n_right = n_true) AS whole_entities,
  sum(n_found)::BIGINT AS candidates, max(n_found) AS most_candidates, count(*) FILTER (n_found = 0) AS without_candidates FROM full_ GROUP BY 1""",
)
def recall_at_k(spark, d):
    scope = E.sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"))
    return metrics.recall_at(scope, E.truth(spark, d), _ranked(spark, d), [1, 5, 10, 15, 20, 25])


@query("evidence_breakdown", f"{_EV}, {O.TRUTH} SELECT has_a, has_b, has_c, count(*) AS pairs FROM ev JOIN truth USING (s1_id, target_id) WHERE has_a OR has_b OR has_c GROUP BY 1, 2, 3")
def evidence_breakdown(spark, d):
    truth = E.truth(spark, d)
    return metrics.evidence_breakdown(truth, _classes(spark, d).of(truth))


@query("missed_matches", f"{_EV}, {O.TRUTH} SELECT s1_id, target_id FROM truth ANTI JOIN ev USING (s1_id, target_id)")
def missed_matches(spark, d):
    truth = E.truth(spark, d)
    return metrics.missed(truth, _classes(spark, d).of(truth)).select("s1_id", "target_id")


@query(
    "experimental_split",
    f"""{_EV}, {O.TRUTH}, m AS (SELECT * FROM truth ANTI JOIN (SELECT * FROM ev WHERE has_a OR has_b OR has_c) USING (s1_id, target_id))
SELECT coalesce(has_d, FALSE) AS has_d, coalesce(has_f, FALSE) AS has_f, count(*) AS pairs FROM m LEFT JOIN ev USING (s1_id, target_id) GROUP BY 1, 2""",
)
def experimental_split(spark, d):
    truth = E.truth(spark, d)
    return metrics.experimental_split(truth, _classes(spark, d).of(truth))


@query(
    "candidate_volume",
    f"""{_EV}, {O.SCOPE}, c AS (SELECT s.s1_id, count(e.target_id) AS n FROM scope s LEFT JOIN ev e USING (s1_id) GROUP BY 1)
SELECT count(*) AS entities, sum(n)::BIGINT AS candidates, round(avg(n), 9) AS mean, max(n) AS largest, count(*) FILTER (n = 0) AS without,
  {", ".join(f"trunc(quantile_cont(n, {q / 100}))::INT AS linear_p{q}" for q in (50, 95, 99))}, {", ".join(f"{x} AS p{q}" for q, x in _PCT.items())} FROM c""",
)
def candidate_volume(spark, d):
    scope = E.sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"))
    return metrics.volume(scope, _classes(spark, d).counts())


@query("candidates_per_source", f"{_EV} SELECT left(target_id, 2) AS source, count(*) AS pairs FROM ev GROUP BY 1")
def candidates_per_source(spark, d):
    return metrics.per_source(_evidence(spark, d))


@query(
    "singleton_candidates",
    f"""{_EV}, {O.TRUTH}, {O.SCOPE}, c AS (SELECT s.s1_id, count(e.target_id) AS n FROM scope s ANTI JOIN truth USING (s1_id) LEFT JOIN ev e ON e.s1_id = s.s1_id GROUP BY 1)
SELECT CASE WHEN n = 0 THEN 'none' WHEN n <= 25 THEN 'up to 25' ELSE 'more' END AS bucket, count(*) AS entities FROM c GROUP BY 1""",
)
def singleton_candidates(spark, d):
    scope = E.sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"))
    return metrics.singleton_candidates(scope, E.truth(spark, d), _evidence(spark, d))


@query(
    "truncation_loss",
    f"""{_RK}, {O.TRUTH} SELECT CASE WHEN rank IS NULL THEN 'not found' WHEN rank <= 3 THEN 'kept' WHEN has_a OR has_b OR has_c THEN 'cut, base evidence'
  ELSE 'cut, experimental evidence' END AS reason, count(*) AS pairs FROM truth LEFT JOIN rk USING (s1_id, target_id) GROUP BY 1""",
)
def truncation_loss(spark, d):
    every = ranking.rank(_evidence(spark, d), ranking.RankingConfig(R33.weights, R33.bonus, 0))
    return metrics.truncation_loss(E.truth(spark, d), every, 3)


@query(
    "script_counts",
    rf"""WITH {O.RECORDS} SELECT country, count(*) AS records, count(*) FILTER (regexp_matches(name, '[ऀ-ൿ]')) AS indic,
  count(*) FILTER (regexp_matches(name, '[^\x00-\xFF]')) AS beyond_latin1, count(*) FILTER (regexp_matches(address, '[0-9]')) AS with_digits FROM rec GROUP BY 1""",
)
def script_counts(spark, d):
    return E.records(spark, d).groupBy("country").agg(
        F.count("*").alias("records"),
        F.count_if(T.has_indic("name")).alias("indic"),
        F.count_if(~T.is_latin1("name")).alias("beyond_latin1"),
        F.count_if(F.col("address").rlike("[0-9]")).alias("with_digits"),
    )


# -- graph, fusion, assignment ---------------------------------------------------------------------------------------


@query(
    "match_components",
    f"""{_EV}, e AS (SELECT s1_id AS u, target_id AS v FROM ev WHERE has_a UNION SELECT target_id, s1_id FROM ev WHERE has_a),
r AS (WITH RECURSIVE w(node, reach) AS (SELECT DISTINCT u, u FROM e UNION SELECT w.node, e.v FROM w JOIN e ON w.reach = e.u) SELECT * FROM w)
SELECT node, min(reach) AS component FROM r GROUP BY 1""",
)
def match_components(spark, d):
    return graph.components(blocking.key_stars(*E.sides(spark, d), "a"))


def _edges(spark, d):
    ranked = _ranked(spark, d)
    scored = ranked.select(F.col("s1_id").alias("u"), F.col("target_id").alias("v"), (F.col("score") / 14).alias("w"))
    rows = E.records(spark, d)
    return scored.unionByName(graph.bridge_edges(rows.filter("source = 'S2'"), rows.filter("source = 'S3'")))


def _exact_slots(spark, d, source: str | None = None):
    best = ranking.best_per_source(_ranked(spark, d).filter("has_a"), by="score")
    wide = best.groupBy("s1_id").agg(*[F.max(F.when(F.col("source") == f"S{i}", F.col("target_id"))).alias(f"s{i}_id") for i in (2, 3)])
    return wide.withColumn(source, F.lit(None).cast("string")) if source else wide


_BEST = f"""{_RK}, b AS (SELECT *, left(target_id, 2) AS src, row_number() OVER (PARTITION BY s1_id, left(target_id, 2) ORDER BY score DESC, target_id) AS rn FROM rk WHERE rank <= 25 AND has_a),
wide AS (SELECT s1_id, max(CASE WHEN src = 'S2' AND rn = 1 THEN target_id END) AS s2_id, max(CASE WHEN src = 'S3' AND rn = 1 THEN target_id END) AS s3_id FROM b GROUP BY 1)"""


@query("best_per_source", f"{_BEST} SELECT * FROM wide")
def best_per_source(spark, d):
    return _exact_slots(spark, d)


@query(
    "transitive_bridge",
    f"""{_BEST}, cl AS (SELECT entity_id, source, ord, lower(country) || '|' || {O.clean_name("name", vocab.SUFFIXES_TIGHT)} AS key, {O.clean_name("name", vocab.SUFFIXES_TIGHT)} AS cn,
  list_distinct({O.tokens("lower(address)")}) AS ws FROM rec),
half AS (SELECT s1_id, s2_id, NULL::VARCHAR AS s3_id FROM wide),
c AS (SELECT h.s1_id, f.entity_id AS other, f.ord FROM half h JOIN cl n ON n.entity_id = h.s2_id AND n.cn <> '' JOIN cl f ON f.key = n.key AND f.source = 'S3'
  WHERE len(list_intersect(n.ws, f.ws)) >= 2 OR (len(n.ws) <= 2 AND len(f.ws) <= 2)),
pick AS (SELECT s1_id, arg_min(other, ord) AS new FROM c GROUP BY 1)
SELECT s1_id, s2_id, new AS s3_id FROM half LEFT JOIN pick USING (s1_id)""",
)
def transitive_bridge(spark, d):
    return graph.transitive(_exact_slots(spark, d, "s3_id"), E.records(spark, d))


@query(
    "recovered_matches",
    f"""{_BEST}, p AS (SELECT s1_id, target_id, score / 14 AS p FROM rk WHERE rank <= 25 AND score / 14 >= 0.25),
best AS (SELECT s1_id, arg_min(target_id, {{'p': -p, 't': target_id}}) FILTER (left(target_id, 2) = 'S2') AS n2, arg_min(target_id, {{'p': -p, 't': target_id}}) FILTER (left(target_id, 2) = 'S3') AS n3 FROM p GROUP BY 1)
SELECT s1_id, n2 AS s2_id, coalesce(s3_id, n3) AS s3_id FROM wide LEFT JOIN best USING (s1_id)""",
)
def recovered_matches(spark, d):
    scored = _ranked(spark, d).select("s1_id", "target_id", (F.col("score") / 14).alias("p"))
    return fusion.recover(_exact_slots(spark, d, "s2_id"), scored, 0.25)


def _lists(spark, d):
    ranked = _ranked(spark, d)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "target_id"))), lambda x: x["target_id"])
    cands = ranked.groupBy("s1_id").agg(listed.alias("candidates"))
    matched = F.array_compact(F.array("s2_id", "s3_id"))
    rows = E.sides(spark, d)[0].select(F.col("entity_id").alias("s1_id"))
    rows = rows.join(_exact_slots(spark, d).select("s1_id", matched.alias("matched")), "s1_id", "left").join(cands, "s1_id", "left")
    empty = F.array().cast("array<string>")
    return rows.select("s1_id", F.coalesce("matched", empty).alias("matched"), F.coalesce("candidates", empty).alias("candidates"))


@query(
    "superset_sync",
    f"""{_BEST}, {O.SCOPE}, c AS (SELECT s1_id, list(target_id ORDER BY rank) AS cands FROM rk WHERE rank <= 25 GROUP BY 1),
m AS (SELECT s.s1_id, list_filter([s2_id, s3_id], lambda x: x IS NOT NULL) AS matched, coalesce(cands, []) AS cands FROM scope s LEFT JOIN wide USING (s1_id) LEFT JOIN c USING (s1_id))
SELECT s1_id, array_to_string(list_concat(matched, list_filter(cands, lambda x: NOT list_contains(matched, x))), ',') AS ids FROM m""",
)
def superset_sync(spark, d):
    return _lists(spark, d).select("s1_id", F.array_join(fusion.superset(F.col("matched"), F.col("candidates")), ",").alias("ids"))


# -- sampling and learning -------------------------------------------------------------------------------------------

_DIGEST = "('0x' || substr(md5('42:' || entity_id), 1, 8))::BIGINT"


@query("holdout_split", f"WITH {O.RECORDS} SELECT entity_id, {_DIGEST} % 10 < 2 AS held_out FROM rec")
def holdout_split(spark, d):
    return sampling.holdout(E.records(spark, d).select("entity_id"), "entity_id")


@query("systematic_sample", f"WITH {O.RECORDS} SELECT entity_id FROM rec WHERE ord % 30 = 0")
def systematic_sample(spark, d):
    return sampling.every_nth(E.records(spark, d)).select("entity_id")


@query("shuffled_sample", f"WITH {O.RECORDS} SELECT entity_id FROM rec ORDER BY {_DIGEST}, entity_id LIMIT 50")
def shuffled_sample(spark, d):
    return sampling.shuffled(E.records(spark, d), "entity_id", 50).select("entity_id")


def _negatives(spark, d):
    return least_pairs.negatives(E.truth(spark, d), *E.sides(spark, d), caps=_CAPS, keep=_keep(spark))


def _labelled(spark, d):
    pairs = learning.training_pairs(E.truth(spark, d), _negatives(spark, d))
    s1, targets = E.sides(spark, d)
    side = lambda df, i, key: df.select(F.col("entity_id").alias(key), T.normalize_name("name").alias(f"name{i}"), F.col("address").alias(f"address{i}"))
    return FV.pair_features(pairs.join(side(s1, 1, "s1_id"), "s1_id").join(side(targets, 2, "target_id"), "target_id"))


@query(
    "training_negatives",
    f"""{_EV}, {O.TRUTH}, pos AS (SELECT s1_id, count(*) AS n FROM truth GROUP BY 1),
neg AS (SELECT e.s1_id, e.target_id, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY e.s1_id ORDER BY ('0x' || substr(md5('42:' || e.s1_id || '|' || e.target_id), 1, 8))::BIGINT, e.target_id) AS rn
  FROM ev e ANTI JOIN truth USING (s1_id, target_id) LEFT JOIN pos ON pos.s1_id = e.s1_id)
SELECT s1_id, target_id FROM neg WHERE rn <= greatest(5 * n, 3)""",
)
def training_negatives(spark, d):
    return _negatives(spark, d)


@query("classifier_scores")
def classifier_scores(spark, d):
    rows = E.staged(f"labelled:{d}", lambda: sampling.holdout(_labelled(spark, d)))
    models = learning.train(rows.filter(~F.col("held_out")), models={"boosted": learning.boosted(), "logistic": learning.ensemble()["logistic"]})
    return learning.score(rows, models, {"boosted": 0.6, "logistic": 0.4}).select("s1_id", "target_id", "label", "held_out", "p")


@query("multi_match", f"""{_RK}, p AS (SELECT s1_id, target_id, score / 14 AS p, row_number() OVER (PARTITION BY s1_id, left(target_id, 2) ORDER BY score DESC, target_id) AS rn FROM rk WHERE rank <= 25)
SELECT s1_id, target_id FROM p WHERE (rn = 1 AND p >= 0.25) OR (rn > 1 AND p >= 0.5)""")
def multi_match(spark, d):
    scored = _ranked(spark, d).select("s1_id", "target_id", (F.col("score") / 14).alias("p"))
    return ranking.multi_match(scored, 0.25, 0.5).select("s1_id", "target_id")


@query("name_embedding_knn")
def name_embedding_knn(spark, d):
    s1, targets = E.sides(spark, d)
    rows = [learning.embed(x.select("entity_id", "country", T.encoder_text("name", "address").alias("t")), "t") for x in (s1, targets)]
    return knn.similar_pairs(*rows, "country", k=3, least=0.5, id_col="entity_id")


# -- across scripts, failures ----------------------------------------------------------------------------------------

_ML_NAME = O.clean_name("name", vocab.SUFFIXES_MULTILINGUAL)


@query(
    "multilingual_exact",
    rf"""WITH {O.RECORDS}, m AS (SELECT entity_id, source, ord, lower(country) || '|' || {_ML_NAME} AS key, {_ML_NAME} AS cn, {_TOKENS} AS ws,
  list_distinct(regexp_extract_all(address, '\b\d+\b')) AS ns FROM rec),
p AS (SELECT s.entity_id AS s1_id, t.entity_id AS target_id, t.source, t.ord, 2 * len(list_intersect(s.ws, t.ws)) + 3 * len(list_intersect(s.ns, t.ns)) AS score
  FROM m s JOIN m t USING (key) WHERE s.source = 'S1' AND t.source <> 'S1' AND s.cn <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY score DESC, ord, target_id) AS rn FROM p)
SELECT s1_id, target_id FROM r WHERE rn = 1""",
)
def multilingual_exact(spark, d):
    return multilingual.exact_tier(*E.sides(spark, d))


@query("multilingual_semantic")
def multilingual_semantic(spark, d):
    s1, targets = E.sides(spark, d)
    pool = multilingual.pool(s1, targets)
    text = lambda df, key: learning.embed(df.select(F.col("entity_id").alias(key), T.encoder_text("name", "address").alias("t")), "t").drop("t")
    a, b = text(s1, "s1_id").withColumnRenamed("embedding", "e1"), text(targets, "target_id").withColumnRenamed("embedding", "e2")
    pairs = pool.join(a, "s1_id").join(b, "target_id").select("s1_id", "target_id", S.cosine(F.col("e1"), F.col("e2")).alias("similarity"))
    return multilingual.semantic_tier(pairs, s1, targets)


@query("dense_first_acceptable")
def dense_first_acceptable(spark, d):
    s1, targets = E.sides(spark, d)
    three = targets.filter("source = 'S3'")
    rows = [learning.embed(x.select("entity_id", "country", "name"), "name") for x in (s1, three)]
    ranked = knn.similar_pairs(*rows, "country", k=15, id_col="entity_id")
    ranked = ranked.select(F.col("query_id").alias("s1_id"), F.col("id").alias("target_id"), "similarity", "rank")
    return multilingual.first_acceptable(ranked, s1, three)


_FALLBACK = f"""WITH {O.RECORDS}, {O.PARTS}, {O.key_table(("a", "d"))}, {O.postings({"d": CAPS["d"]})},
p AS (SELECT DISTINCT key_type, s.entity_id AS s1_id, q.entity_id AS target_id FROM keyed s JOIN posted q USING (key_type, key) WHERE s.source = 'S1'),
n AS (SELECT s1_id FROM p WHERE key_type = 'a' GROUP BY 1 HAVING count(*) >= 5)
SELECT s1_id, target_id FROM p WHERE key_type = 'a' UNION SELECT s1_id, target_id FROM p WHERE key_type = 'd' AND s1_id NOT IN (SELECT s1_id FROM n)"""


@query("conditional_fallback", _FALLBACK)
def conditional_fallback(spark, d):
    return multilingual.classes_with_fallback(_classes(spark, d, ("a", "d"), {"d": CAPS["d"]}))
