"""Queries over scalars: names, addresses, identities, similarities, features; and the SQL that says the same.

Documents hold few identities and places, so records are given some: SIGNS says which, in SQL that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import address as A
from kindred.functions import anchors as N
from kindred.functions import features as FV
from kindred.functions import similarity as S
from kindred.functions import text as T
from kindred.functions import vocab
from kindred.operators import fusion, keys, ranking
from kindred.plans import catalogue as C
from kindred.plans import entities as E
from kindred.plans import oracle as O
from kindred.plans import presets
from kindred.plans.catalogue import query


def _digits(of: str, n: int) -> str:
    return f"lpad(CAST({of} AS STRING), {n}, '0')"


#: Country, name and address of signed records, by place in reading order.
SIGNS = {
    "country": "CASE CAST(floor(ord / 3) AS BIGINT) % 3 WHEN 0 THEN 'India' WHEN 1 THEN 'FR' ELSE ' usa ' END",
    "name": f"""name || CASE ord % 8 WHEN 0 THEN ' GSTIN ' || {_digits("ord % 5 + 10", 2)} || 'abcde' || {_digits("ord % 7", 4)} || 'F1Z5'
      WHEN 1 THEN ' (pan) ABCPE' || {_digits("ord % 5", 4)} || 'k' WHEN 2 THEN ' U12345MH2001PTC' || {_digits("ord % 5", 6)}
      WHEN 3 THEN ' www.shop' || CAST(ord % 9 AS STRING) || '.co.in' WHEN 4 THEN ' x@gmail.com' WHEN 5 THEN ' 123 456 ' || {_digits("ord % 7", 3)}
      WHEN 6 THEN ' EIN 12-' || {_digits("ord % 5", 7)} ELSE ' Ltd. (id: 12) d.b.a. Shop No. 1' END""",
    "address": f"""address || CASE ord % 7 WHEN 0 THEN ', Pune, Maharashtra 411' || {_digits("ord % 1000", 3)} WHEN 1 THEN ', Lyon 69' || {_digits("ord % 20 + 1", 3)}
      WHEN 2 THEN ' New York TX ' || {_digits("ord % 99999", 5)} || '-1234' WHEN 3 THEN ' tel +91 98765-' || {_digits("ord % 5", 5)}
      WHEN 4 THEN ' NY, CA ' || {_digits("ord % 90000 + 10000", 5)} WHEN 5 THEN ' Bangalore, Tamil Nadu, 5600' || {_digits("ord % 90 + 10", 2)}
      ELSE ' Paris 750' || {_digits("ord % 20 + 1", 2)} || ' Delhi' END""",
}
SIGNED = f"{O.RECORDS}, sg AS (SELECT entity_id, source, ord, {', '.join(f'{x} AS {c}' for c, x in SIGNS.items())} FROM rec)"


def signed(spark: SparkSession, d: str) -> DataFrame:
    rows = E.records(spark, d).select("entity_id", "source", "ord", "name", "address")
    return rows.select("entity_id", "source", "ord", *[F.expr(x).alias(c) for c, x in SIGNS.items()])


def _known(x: str) -> str:
    return f"coalesce({x}, '')"


def _land(names: str) -> str:
    return f"upper(trim(country)) IN ({', '.join(repr(n) for n in names.split('|'))})"


# -- names -----------------------------------------------------------------------------------------------------------

_FOLD = r"regexp_replace(strip_accents(name), '[^\x00-\x7F]', '', 'g')"
_SUPER = f"regexp_split_to_array({_FOLD}, '{T.TRADE_NAME}')[-1]"
for _p in (T.METADATA, T.DOMAIN_ENDING):
    _SUPER = f"regexp_replace({_SUPER}, '{_p}', ' ', 'g')"
_SUPER = f"regexp_replace(trim({_SUPER}), '{T.HONORIFIC}', '', 'g')"


def _closed(x: str) -> str:
    """Dots between word characters dropped; twice, as a match takes the character after it."""
    for _ in range(2):
        x = rf"regexp_replace({x}, '(\w)\.(\w)', '\1\2', 'g')"
    return x


@query(
    "folded_names",
    rf"""WITH {SIGNED} SELECT entity_id, {O.clean_name(_closed(_FOLD), vocab.SUFFIXES_TIGHT)} AS enhanced, {O.clean_name(_closed(_SUPER), vocab.SUFFIXES_SUPER)} AS cleaned FROM sg""",
)
def folded_names(spark, d):
    """[ST9, ST10]"""
    return signed(spark, d).select("entity_id", T.clean_name_enhanced("name").alias("enhanced"), T.super_clean_name("name").alias("cleaned"))


#: Word borders are those of Unicode, which RE2's are not.
_SETS = r"list_distinct(list_filter(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+'), lambda t: regexp_full_match(t, '[a-z0-9]{{3,}}')))"


@query(
    "address_texts",
    rf"""WITH {SIGNED} SELECT entity_id, array_to_string({O.tokens(O.non_words("lower(address)"))}, ' ') AS normalized,
  array_to_string(list_sort({_SETS.format("address")}), ' ') AS words, CASE WHEN address = '' THEN name ELSE name || ' | ' || address END AS encoded FROM sg""",
)
def address_texts(spark, d):
    """[ST5, ST18, ST19]"""
    return signed(spark, d).select(
        "entity_id",
        T.normalize_address("address").alias("normalized"),
        F.array_join(F.array_sort(T.ascii_token_set("address")), " ").alias("words"),
        T.encoder_text("name", "address").alias("encoded"),
    )


# -- addresses -------------------------------------------------------------------------------------------------------


def _first_listed(x: str, values: list[str]) -> str:
    return f"coalesce(list_filter({x}, lambda t: list_contains({O.words(values)}, t))[1], '')"


_LOWER_WORDS = "regexp_extract_all(lower(address), '[a-z]+')"
_TOKENS_LOWER = O.tokens("lower(address)")


@query(
    "address_numbers_and_codes",
    rf"""WITH {SIGNED}, t AS (SELECT *, {_TOKENS_LOWER} AS w FROM sg)
SELECT entity_id, coalesce(list_filter(w, lambda t: {O.DIGITS})[1], '') || '_' || coalesce(list_filter(w, lambda t: {O.ALPHA} AND length(t) > 2)[1], '') AS loose,
  regexp_extract(address, '\b\d{{4,6}}\b') AS pin4, regexp_extract(address, '\b\d{{5,6}}\b') AS pin5, regexp_extract_all(address, '\b\d{{4,6}}\b')[-1] AS last_postal,
  nullif(regexp_extract(address, '\b\d{{6}}\b'), '') AS pincode,
  {_first_listed(r"regexp_extract_all(address, '\b([A-Z]{2})\b', 1)", vocab.US_STATES)} AS state,
  {_first_listed("list_transform(w, lambda t: regexp_replace(t, '[^" + chr(92) + "p{L}" + chr(92) + "p{N}_]', '', 'g'))", vocab.INDIA_PLACES)} AS place,
  array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(lower(address), '[\p{{L}}\p{{N}}_]+')), lambda t: length(t) >= 1)), ' ') AS every_word FROM t""",
)
def address_numbers_and_codes(spark, d):
    """[AD7, AD10, AD11, AD13, AD15, AD17, AD22]"""
    return signed(spark, d).select(
        "entity_id",
        A.loose_anchor("address").alias("loose"),
        A.first_pin("address").alias("pin4"),
        A.first_pin("address", 5).alias("pin5"),
        A.last_postal("address").alias("last_postal"),
        A.pincode("address").alias("pincode"),
        A.us_state("address").alias("state"),
        A.geo_token("address", vocab.INDIA_PLACES).alias("place"),
        F.array_join(F.array_sort(A.address_tokens("address", 1, [])), " ").alias("every_word"),
    )


def _cases(table: dict[str, str], test: str) -> str:
    """The value of the first entry, in the table's order, whose key passes the test."""
    return "CASE " + " ".join(f"WHEN {test.format(k.replace(chr(39), chr(39) * 2))} THEN '{v}'" for k, v in table.items()) + " END"


_KEYWORDS = {k: code for code, ks in vocab.STATE_KEYWORDS.items() for k in ks}
_GEO = f"""CASE land WHEN 'us' THEN {_first_listed(r"regexp_extract_all(address, '\b([A-Z]{2})\b', 1)", vocab.US_STATES)}
  WHEN 'india' THEN coalesce(list_min(list_filter({_LOWER_WORDS}, lambda t: list_contains({O.words(vocab.INDIA_PLACES)}, t))), '')
  WHEN 'france' THEN coalesce(list_min(list_filter({_LOWER_WORDS}, lambda t: list_contains({O.words(vocab.FRANCE_PLACES)}, t))), '') ELSE '' END"""
_EDGED = r"regexp_matches(lower(address), '(^|[^\p{{L}}\p{{N}}_])\Q{}\E([^\p{{L}}\p{{N}}_]|$)')"
_CANONICAL = f"""coalesce(CASE WHEN land = 'india' AND address <> '' THEN coalesce({_cases(vocab.INDIA_STATE_ALIASES, _EDGED)},
  {_cases(vocab.CITY_SYNONYMS, "contains(lower(address), '{}')")}) END, {_GEO})"""
_AUDIT = rf"""coalesce(CASE land WHEN 'us' THEN list_filter(regexp_split_to_array(replace(address, ',', ' '), '\s+'), lambda t: list_contains({O.words(vocab.US_STATES)}, t))[-1]
  WHEN 'india' THEN {_cases(_KEYWORDS, "contains(lower(address), '{}')")}
  WHEN 'france' THEN regexp_extract(address, '\b(0[1-9]|[1-8]\d|9[0-5]|97|98)\d{{3}}\b', 1) END, '')"""
_CODES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.STATE_CODES.items()) + "}"
_CODE = f"""coalesce({_cases({k: vocab.STATE_CODES[k] for k in vocab.MULTI_WORD_STATES}, "contains(lower(address), '{}')")},
  list_filter(list_transform({_LOWER_WORDS}, lambda t: {_CODES}[t]), lambda c: c IS NOT NULL)[1])"""
_SIGNED_LAND = "CASE country WHEN 'India' THEN 'india' WHEN 'FR' THEN 'france' ELSE 'us' END"


def _landed(spark, d):
    land = F.expr(_SIGNED_LAND)
    return signed(spark, d).withColumn("land", land)


@query("places", f"WITH {SIGNED}, t AS (SELECT *, {_SIGNED_LAND} AS land FROM sg) SELECT entity_id, {_GEO} AS geo, {_CANONICAL} AS canonical, {_AUDIT} AS audit, {_CODE} AS code FROM t")
def places(spark, d):
    """[AD16, AD18, AD19, AD20]"""
    return _landed(spark, d).select(
        "entity_id",
        A.geo("address", "land").alias("geo"),
        A.canonical_geo("address", "land").alias("canonical"),
        A.audit_state("address", "land").alias("audit"),
        A.state_code("address").alias("code"),
    )


# -- identities ------------------------------------------------------------------------------------------------------

_BOTH = "name || ' ' || address"


def _last(pattern: str, of: str = _BOTH) -> str:
    return f"regexp_extract_all({of}, '{pattern}')[-1]"


_ANCHORS = {
    "GSTIN": f"CASE WHEN {_land(A.INDIA)} THEN upper({_last(N.GSTIN)}) END",
    "PAN": f"CASE WHEN {_land(A.INDIA)} THEN upper({_last(N.PAN)}) END",
    "CIN": f"CASE WHEN {_land(A.INDIA)} THEN upper({_last(N.CIN)}) END",
    "SIREN": f"CASE WHEN {_land(A.FRANCE)} THEN replace({_last(N.SIREN)}, ' ', '') END",
    "EIN": f"CASE WHEN {_land(A.US)} THEN {_last(N.EIN)} END",
    "POSTAL": rf"""CASE WHEN {_land(A.INDIA)} THEN {_last(r"\b[1-9][0-9]{5}\b", "address")} WHEN {_land(A.FRANCE)} THEN {_last(r"\b(?:0[1-9]|[1-8][0-9]|9[0-8])[0-9]{3}\b", "address")}
      WHEN {_land(A.US)} THEN left({_last(r"\b[0-9]{5}(?:-[0-9]{4})?\b", "address")}, 5) END""",
    "PHONE": rf"""right(list_filter(list_transform(regexp_extract_all({_BOTH}, '{N.PHONE_ASCII}'), lambda m: regexp_replace(m, '\D', '', 'g')), lambda x: length(x) BETWEEN 10 AND 13)[1], 10)""",
    "DOMAIN": f"list_filter(list_transform(regexp_extract_all({_BOTH}, '{N.DOMAIN}', 1), lambda h: lower(h)), lambda h: NOT list_contains({O.words(vocab.MAIL_HOSTS)}, h) AND length(h) > 4)[1]",
}
_ANCHORED = f"{SIGNED}, an AS (SELECT *, {', '.join(f'{x} AS {c}' for c, x in _ANCHORS.items())} FROM sg)"


@query("identity_anchors", f"WITH {_ANCHORED} SELECT entity_id, {', '.join(_ANCHORS)} FROM an")
def identity_anchors(spark, d):
    """[AN1-AN4, AD12]"""
    return signed(spark, d).select("entity_id", N.anchors("name", "address", "country").alias("a")).select("entity_id", "a.*")


_COUNTRY_KEY = "lower(trim(country))"
_IDENTITY = " UNION ALL ".join(
    [f"SELECT entity_id, source, 'tax' AS kind, {_COUNTRY_KEY} || '|{t}|' || {t} AS key FROM an" for t in N.TAX_TYPES]
    + [f"SELECT entity_id, source, 'phone', {_COUNTRY_KEY} || '|' || PHONE FROM an", "SELECT entity_id, source, 'domain', DOMAIN FROM an"]
)
_IDENTITY = f"{_ANCHORED}, ik AS (SELECT DISTINCT * FROM ({_IDENTITY}) WHERE key IS NOT NULL)"


@query("identity_keys", f"WITH {_IDENTITY} SELECT entity_id, kind, replace(key, '|', ' ') AS key FROM ik")
def identity_keys(spark, d):
    """[KV1-KV3]"""
    rows = keys.identity_keys(signed(spark, d)).select("entity_id", "kind", F.translate("key", keys.SEPARATOR, " ").alias("key"))
    return rows.distinct()


def _weights(table: dict[str, float]) -> str:
    return "CASE a.kind " + " ".join(f"WHEN '{k}' THEN {w}::DOUBLE" for k, w in table.items()) + " END"


@query(
    "anchor_edges",
    f"""WITH {_IDENTITY} SELECT a.entity_id AS u, b.entity_id AS v, max({_weights(N.PROBE_WEIGHTS)}) AS w FROM ik a JOIN ik b USING (kind, key)
  WHERE a.source = 'S1' AND b.source <> 'S1' GROUP BY 1, 2""",
)
def anchor_edges(spark, d):
    """[AN5, J9]"""
    rows = signed(spark, d)
    return presets.anchor_edges(rows.filter("source = 'S1'"), rows.filter("source <> 'S1'"), N.PROBE_WEIGHTS)


_BRIDGE = {k: w for k, w in N.BRIDGE_WEIGHTS.items() if k in ("tax", "phone")}


@query(
    "anchor_bridges",
    f"""WITH {_IDENTITY} SELECT a.entity_id AS u, b.entity_id AS v, max({_weights(_BRIDGE)}) AS w FROM ik a JOIN ik b USING (kind, key)
  WHERE a.source = 'S2' AND b.source = 'S3' AND kind <> 'domain' GROUP BY 1, 2""",
)
def anchor_bridges(spark, d):
    """[AN5, J11]"""
    rows = signed(spark, d)
    return presets.anchor_edges(rows.filter("source = 'S2'"), rows.filter("source = 'S3'"), _BRIDGE)


# -- similarity of pairs ---------------------------------------------------------------------------------------------


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: row by row, a cell is the greatest, so far in its row, of the cell above and
    the one before that plus a match."""
    rows = f"list_transform(string_split({a}, ''), lambda x: list_transform(string_split({b}, ''), lambda y: (x = y)::INT))"
    zero = f"list_transform(string_split({b}, ''), lambda y: 0)"
    cell = "greatest(acc[i], coalesce(acc[i - 1], 0) + m[i])"
    step = f"list_transform(range(1, len(m) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: {cell})))"
    reduced = f"list_reduce(list_prepend({zero}, {rows}), lambda acc, m: {step})"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_last({reduced}) END)"


def indel(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = '' AND {b} = '' THEN 100.0 ELSE 200.0 * {lcs(a, b)} / (length({a}) + length({b})) END)"


def _sorted(x: str) -> str:
    return f"array_to_string(list_sort({O.tokens(x)}), ' ')"


#: Names of pairs, each pair of names once, with their measures; names are normalized where the queries say so.
def measures(a: str, b: str) -> str:
    return rf"""nm0 AS (SELECT DISTINCT {a} AS a, {b} AS b FROM pairs),
nm1 AS (SELECT *, {_sorted("a")} AS sa, {_sorted("b")} AS sb, list_sort(list_distinct({O.tokens("a")})) AS x, list_sort(list_distinct({O.tokens("b")})) AS y FROM nm0),
nm2 AS (SELECT *, array_to_string(list_filter(x, lambda t: list_contains(y, t)), ' ') AS sect, array_to_string(list_filter(x, lambda t: NOT list_contains(y, t)), ' ') AS l,
  array_to_string(list_filter(y, lambda t: NOT list_contains(x, t)), ' ') AS r FROM nm1),
nm3 AS (SELECT *, (sect <> '')::INT AS gap, {lcs("l", "r")} AS inner_, {indel("a", "b")} AS ratio, {indel("sa", "sb")} AS token_sort_ratio,
  list_max(list_transform(range(1, length(a) + 1), lambda i: list_max(list_transform(range(0, length(a) - i + 2), lambda n: CASE WHEN contains(b, substr(a, i, n)) THEN n ELSE 0 END)))) AS longest FROM nm2),
nm AS (SELECT a, b, ratio::DOUBLE AS ratio, token_sort_ratio::DOUBLE AS token_sort_ratio,
  CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN sect <> '' AND (l = '' OR r = '') THEN 100.0 ELSE greatest(
    100.0 * (1 - (length(l) + length(r) - 2 * inner_) / (2.0 * length(sect) + 2 * gap + length(l) + length(r))),
    CASE WHEN sect <> '' THEN 100.0 * (1 - (gap + length(l)) / (2.0 * length(sect) + gap + length(l))) ELSE 0 END,
    CASE WHEN sect <> '' THEN 100.0 * (1 - (gap + length(r)) / (2.0 * length(sect) + gap + length(r))) ELSE 0 END) END::DOUBLE AS token_set_ratio,
  (100.0 * coalesce(longest, 0) / greatest(length(a), length(b), 1))::DOUBLE AS substring_ratio FROM nm3)"""


_EDIT = ["ratio", "token_set_ratio", "token_sort_ratio", "substring_ratio"]


@query(
    "edit_ratios",
    f"{C._PAIRS_SQL}, {measures('n1', 'n2')} SELECT s1_id, target_id, {', '.join(f'round({m}, 6) AS {m}' for m in _EDIT)}, round(0.6 * ratio + 0.4 * token_set_ratio, 6) AS fuzzy FROM pairs JOIN nm ON n1 = a AND n2 = b",
)
def edit_ratios(spark, d):
    """[SM1, SM2, SM3, SM6, SM13]"""
    n = [T.normalize_name(c) for c in ("name1", "name2")]
    rows = C._pairs(spark, d).withColumn("m", S.edit_measures(*n)).withColumn("f", S.fuzzy_score(*n))
    return rows.select("s1_id", "target_id", *[F.round(F.col(f"m.{m}"), 6).alias(m) for m in _EDIT], F.round("f", 6).alias("fuzzy"))


def _windows(short: str, long: str) -> str:
    """Windows of the longer name, at both ends shorter ones."""
    return f"list_transform(range(1 - length({short}), length({long})), lambda i: substr({long}, greatest(i, 0) + 1, i + length({short}) - greatest(i, 0)))"


@query(
    "partial_ratios",
    f"""{C._PAIRS_SQL}, n AS (SELECT DISTINCT split_part(n1, ' ', 1) AS a, split_part(n2, ' ', 2) AS b FROM pairs),
o AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM n),
w AS (SELECT a, b, s, unnest({_windows("s", "l")}) AS t FROM o UNION ALL SELECT a, b, l, unnest({_windows("l", "s")}) FROM o WHERE length(s) = length(l)),
best AS (SELECT a, b, max({indel("s", "t")}) AS p FROM w WHERE s <> '' GROUP BY 1, 2)
SELECT s1_id, target_id, round(CASE WHEN a = '' OR b = '' THEN CASE WHEN a = b THEN 100.0 ELSE 0.0 END ELSE p END, 6)::DOUBLE AS partial FROM pairs
  JOIN n ON n.a = split_part(n1, ' ', 1) AND n.b = split_part(n2, ' ', 2) LEFT JOIN best USING (a, b)""",
)
def partial_ratios(spark, d):
    """[SM4] of a word of each name."""
    n1, n2 = (T.normalize_name(c) for c in ("name1", "name2"))
    a, b = T.first_word(n1), F.split_part(n2, F.lit(" "), F.lit(2))
    m = S.edit_measures(a, b)["partial_ratio"]
    return C._pairs(spark, d).select("s1_id", "target_id", F.round(m, 6).alias("partial"))


_W = ["list_distinct(" + O.tokens(f"n{i}") + ")" for i in (1, 2)]
_CA = [O.clean(f"lower(address{i})") for i in (1, 2)]


@query(
    "pair_signals",
    rf"""{C._PAIRS_SQL}, t AS (SELECT pairs.*, {O.tokens("n1")} AS t1, {O.tokens("n2")} AS t2, {_W[0]} AS w1, {_W[1]} AS w2, {_CA[0]} AS c1, {_CA[1]} AS c2,
  list_distinct(list_filter({O.tokens(_CA[0])}, lambda t: length(t) >= 2)) AS a1, list_distinct(list_filter({O.tokens(_CA[1])}, lambda t: length(t) >= 2)) AS a2,
  p.sig AS g1, q.sig AS g2, p.nums AS d1, q.nums AS d2, p.street AS s1, q.street AS s2 FROM pairs JOIN parts p ON p.entity_id = s1_id JOIN parts q ON q.entity_id = target_id),
u AS (SELECT *, len(list_intersect(w1, w2)) AS nw, len(list_intersect(a1, a2)) AS na FROM t)
SELECT s1_id, target_id, n1 = n2 AS exact_name_match, CASE WHEN len(w1) + len(w2) = 0 THEN 1.0 ELSE round(nw / (len(w1) + len(w2) - nw), 4) END::DOUBLE AS name_jaccard, nw::INT AS shared_name_tokens,
  len(list_intersect(g1, g2))::INT AS shared_significant_tokens, n1 <> '' AND n2 <> '' AND (contains(n1, n2) OR contains(n2, n1)) AS name_contained,
  abs(length(n1) - length(n2))::INT AS name_length_diff, list_sort(t1) = list_sort(t2) AND t1 <> t2 AND len(t1) > 1 AS name_reordered,
  regexp_matches(name1, '[^\P{{L}}\p{{Latin}}]') OR regexp_matches(name2, '[^\P{{L}}\p{{Latin}}]') AS not_latin,
  c1 = c2 AS exact_address_match, CASE WHEN len(a1) + len(a2) = 0 THEN 1.0 ELSE round(na / (len(a1) + len(a2) - na), 4) END::DOUBLE AS address_jaccard, na::INT AS shared_address_tokens,
  len(list_intersect(d1, d2))::INT AS shared_numbers, len(d1) > 0 AS has_digits1, len(d2) > 0 AS has_digits2, len(d1) = 0 AND len(d2) = 0 AS both_no_digits,
  len(d1) = 0 OR len(d2) = 0 AS either_no_digits, coalesce(len(s1) >= 2 AND len(s2) >= 2 AND s1[1] = s2[1], FALSE) AS first_street_match,
  coalesce(len(s1) >= 2 AND len(s2) >= 2 AND s1[2] = s2[2], FALSE) AS second_street_match FROM u""",
)
def pair_signals(spark, d):
    """[FVD, SM7, SM10, SM11, PF7] without the ratio of difflib, which SQL can't say."""
    rows = FV.diagnostics(C._pairs(spark, d))
    kept = [c for c in rows.columns if c not in ("name1", "name2", "address1", "address2", "country1", "country2", "country_match", "name_char_ratio")]
    return rows.select(*kept)


_FEATURE_SQL = {
    "ratio": "round(ratio, 6)",
    "token_set_ratio": "round(token_set_ratio, 6)",
    "token_sort_ratio": "round(token_sort_ratio, 6)",
    "substring_ratio": "round(substring_ratio, 6)",
    "jaro_winkler": "round(100 * jaro_winkler_similarity(name1, name2), 6)",
    "length_diff": "abs(length(name1) - length(name2))::DOUBLE",
    "word_diff": f"abs(len({O.tokens('name1')}) - len({O.tokens('name2')}))::DOUBLE",
    "address_overlap": "shared::DOUBLE",
    "address_jaccard": "CASE WHEN len(a1) + len(a2) - shared = 0 THEN 0.0 ELSE round(100.0 * shared / (len(a1) + len(a2) - shared), 6) END::DOUBLE",
    "state_match": "(st1 <> '' AND st1 = st2)::INT::DOUBLE",
    "state_conflict": "(st1 <> '' AND st2 <> '' AND st1 <> st2)::INT::DOUBLE",
    "city_match": "(geo1 <> '' AND geo1 = geo2)::INT::DOUBLE",
    "city_conflict": "(geo1 <> '' AND geo2 <> '' AND geo1 <> geo2)::INT::DOUBLE",
    "number_match": "coalesce(d1 = d2, FALSE)::INT::DOUBLE",
    "number_conflict": "coalesce(d1 <> d2, FALSE)::INT::DOUBLE",
    "condensed_match": "(name1 <> '' AND replace(name1, ' ', '') = replace(name2, ' ', ''))::INT::DOUBLE",
    "first_word_match": "(split_part(name1, ' ', 1) <> '' AND split_part(name1, ' ', 1) = split_part(name2, ' ', 1))::INT::DOUBLE",
}
_ASCII_NAME = "regexp_replace(n{}, '[^\\x00-\\x7F]', '', 'g')"


def _geo_of(i: int) -> str:
    return f"coalesce(list_min(list_filter(regexp_extract_all(lower(address{i}), '[a-z]+'), lambda t: list_contains({O.words(E.PLACES_FRANCE)}, t))), '')"


def _state_of(i: int) -> str:
    return f"CASE ord{i} % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' WHEN 2 THEN 'TX' ELSE '' END"


def _feature_pairs(spark, d):
    """Pairs with ASCII names, as DuckDB's Jaro-Winkler compares bytes, a place and a state."""
    rows = C._pairs(spark, d)
    ords = rows.withColumns({f"ord{i}": F.split_part(F.col(c), F.lit("-"), F.lit(2)).cast("long") for i, c in ((1, "s1_id"), (2, "target_id"))})
    place = {f"geo{i}": A.geo(f"address{i}", F.lit("france"), None, E.PLACES_FRANCE) for i in (1, 2)}
    state = {f"state{i}": F.expr(_state_of(i)) for i in (1, 2)}
    names = {f"name{i}": F.regexp_replace(T.normalize_name(f"name{i}"), "[^\\x00-\\x7F]", "") for i in (1, 2)}
    return ords.withColumns(place | state).withColumns(names)


def _feature_query(name: str, which: list[str], tokens) -> None:
    which = [c for c in which if c != "partial_ratio"]
    rounded = {"ratio", "token_set_ratio", "token_sort_ratio", "substring_ratio", "jaro_winkler", "address_jaccard"}
    number = r"list_filter(regexp_extract_all(address{}, '\b\d+\b'), lambda x: length(x) <= 5)[1]"
    sql = f"""{C._PAIRS_SQL.replace("a.name AS name1, b.name AS name2,", "a.ord AS ord1, b.ord AS ord2,")},
pairs2 AS (SELECT s1_id, target_id, address1, address2, ord1, ord2, {_ASCII_NAME.format(1)} AS name1, {_ASCII_NAME.format(2)} AS name2 FROM pairs),
{measures("name1", "name2").replace("FROM pairs)", "FROM pairs2)", 1)},
t AS (SELECT *, {tokens("address1")} AS a1, {tokens("address2")} AS a2, {_state_of(1)} AS st1, {_state_of(2)} AS st2, {_geo_of(1)} AS geo1, {_geo_of(2)} AS geo2,
  {number.format(1)} AS d1, {number.format(2)} AS d2 FROM pairs2 JOIN nm ON name1 = a AND name2 = b),
o AS (SELECT *, len(list_intersect(a1, a2)) AS shared FROM t)
SELECT s1_id, target_id, {", ".join(f"{_FEATURE_SQL[c]} AS {c}" for c in which)} FROM o"""

    def run(spark, d):
        full = FV.EIGHTEEN if name == "features_18_checked" else which
        rows = FV.pair_features(_feature_pairs(spark, d), full)
        return rows.select("s1_id", "target_id", *[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in which])

    query(name, sql)(run)


def _plain_words(x: str) -> str:
    return f"list_distinct({O.tokens(f'lower({x})')})"


for _n, _f in {"6": FV.SIX, "10": FV.TEN, "16": FV.SIXTEEN, "18": FV.EIGHTEEN}.items():
    # [FV6, FV10, FV16, FV18] without the partial ratio, which partial_ratios checks.
    _feature_query(f"features_{_n}_checked", _f, C._ft if _n == "18" else _plain_words)


@query(
    "scaled_scores",
    f"{C._RK} SELECT s1_id, target_id, round(1 / (1 + exp(-(score - 5))), 9) AS p FROM rk WHERE rank <= 25",
)
def scaled_scores(spark, d):
    """[SM17]"""
    return ranking.rank(C._evidence(spark, d)).select("s1_id", "target_id", F.round(S.sigmoid(F.col("score") - 5), 9).alias("p"))


@query(
    "vector_cosines",
    """SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def vector_cosines(spark, d):
    """[SM16]"""
    rows = E.table(spark, d, "embeddings").select("vec_id", "embedding")
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("e"))
    similarity = F.round(S.cosine(F.col("embedding"), F.col("e")), 9).alias("similarity")
    return rows.join(other, "vec_id").select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"), similarity)


_SCRIPTS = T.SCRIPTS


@query(
    "script_presence",
    rf"""WITH {O.RECORDS}, s AS (SELECT country, name || CASE ord % 10 {" ".join(f"WHEN {i} THEN chr({ord(v[1])} + 5)" for i, v in enumerate(_SCRIPTS.values()))} ELSE ' ß œ' END AS name FROM rec)
SELECT country, count(*) AS records, {", ".join(f"count(*) FILTER (regexp_matches(name, '{v}')) AS {k}" for k, v in _SCRIPTS.items())},
  count(*) FILTER (regexp_matches(name, '[^\P{{L}}\p{{Latin}}]')) AS not_latin FROM s GROUP BY 1""",
)
def script_presence(spark, d):
    """[PF6, PF7, AG16, EV6]"""
    rows = E.records(spark, d)
    sign = F.coalesce(*[F.when(F.col("ord") % 10 == i, F.lit(chr(ord(v[1]) + 5))) for i, v in enumerate(_SCRIPTS.values())], F.lit(" ß œ"))
    rows = rows.withColumn("name", F.concat("name", sign))
    found = [F.count_if(T.has_script("name", k)).alias(k) for k in _SCRIPTS]
    return rows.groupBy("country").agg(F.count("*").alias("records"), *found, F.count_if(~T.is_latin("name")).alias("not_latin"))


@query(
    "suspect_pairs",
    rf"""{C._PAIRS_SQL}, t AS (SELECT s1_id, target_id, CASE split_part(s1_id, '-', 2)::INT % 5 WHEN 0 THEN 'us' ELSE 'France ' END AS country1, CASE split_part(target_id, '-', 2)::INT % 7 WHEN 0 THEN 'us' ELSE 'france' END AS country2,
  'name ' || split_part(n1, ' ', 3) AS na, split_part(n2, ' ', 3) AS nb, '69' || lpad((split_part(s1_id, '-', 2)::INT % 3)::VARCHAR, 3, '0') AS aa, '69' || lpad('1', 3, '0') AS ab0, split_part(target_id, '-', 2)::INT % 2 AS odd FROM pairs),
v AS (SELECT s1_id, target_id, country1, country2, na, nb, aa, CASE WHEN odd = 1 THEN ab0 ELSE '75001' END AS ab FROM t WHERE lower(trim(country1)) = lower(trim(country2))),
w AS (SELECT *, {_SETS.format("na || ' ' || aa")} AS wa, {_SETS.format("nb || ' ' || ab")} AS wb,
  CASE WHEN lower(trim(country1)) = 'france' THEN left(aa, 2) ELSE '' END AS sa, CASE WHEN lower(trim(country2)) = 'france' THEN left(ab, 2) ELSE '' END AS sb FROM v)
SELECT s1_id, target_id, CASE WHEN sa <> '' AND sb <> '' AND sa <> sb THEN 'state_conflict' WHEN len(wa) > 0 AND len(wb) > 0 AND len(list_intersect(wa, wb)) = 0 THEN 'low_overlap' END AS reason FROM w""",
)
def suspect_pairs(spark, d):
    """[PF4, PF12, ST18, AD19]"""
    number = lambda c: F.split_part(F.col(c), F.lit("-"), F.lit(2)).cast("int")
    n1, n2 = (F.split_part(T.normalize_name(c), F.lit(" "), F.lit(3)) for c in ("name1", "name2"))
    rows = C._pairs(spark, d).select(
        "s1_id",
        "target_id",
        F.when(number("s1_id") % 5 == 0, "us").otherwise("France ").alias("country1"),
        F.when(number("target_id") % 7 == 0, "us").otherwise("france").alias("country2"),
        F.concat(F.lit("name "), n1).alias("name1"),
        n2.alias("name2"),
        F.concat(F.lit("6900"), (number("s1_id") % 3).cast("string")).alias("address1"),
        F.when(number("target_id") % 2 == 1, "69001").otherwise("75001").alias("address2"),
    )
    return fusion.suspects(rows).select("s1_id", "target_id", "reason")
