"""DuckDB SQL for the queries of the catalogue, from shared pieces."""

from __future__ import annotations

from kindred.functions import vocab
from kindred.plans import entities


def words(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def clean(x: str) -> str:
    return rf"regexp_replace({x}, '[\p{{P}}\p{{S}}]', ' ', 'g')"


def non_words(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"


def tokens(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda t: t <> '')"


def without(x: str, stop: list[str]) -> str:
    return f"list_filter({x}, lambda t: NOT list_contains({words(stop)}, t))"


ALPHA = r"regexp_full_match(t, '\p{L}+')"
DIGITS = r"regexp_full_match(t, '\p{Nd}+')"


def by_length(x: str) -> str:
    return f"list_transform(list_sort(list_transform({x}, lambda t: {{'n': -length(t), 't': t}})), lambda s: s.t)"


def clean_name(x: str, suffixes: list[str]) -> str:
    return f"array_to_string({without(tokens(non_words(f'lower({x})')), suffixes)}, ' ')"


RECORDS = rf"""
doc_words AS (SELECT doc_id, lang, n_chars, {tokens("lower(text)")} AS w FROM documents),
rec AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, 'S' || (1 + doc_id % 3) AS source,
  array_to_string(w[1:4], ' ') AS name, (n_chars // 100) || ' ' || array_to_string(w[5:16], ' ') AS address,
  lang AS country, doc_id AS ord, md5(array_to_string(w, ' ')) AS content FROM doc_words)"""

PARTS = rf"""
parts1 AS (SELECT *, {without(tokens(clean("lower(name)")), vocab.LEGAL_SUFFIXES)} AS nt,
  {tokens(clean("lower(address)"))} AS aw FROM rec),
parts AS (SELECT *, array_to_string(nt, ' ') AS nn,
  list_filter({without("nt", vocab.NAME_STOP_WORDS)}, lambda t: length(t) >= 4 AND {ALPHA}) AS sig,
  list_filter(aw, lambda t: {DIGITS}) AS nums,
  list_filter(aw, lambda t: {ALPHA} AND length(t) > 2) AS alpha,
  list_filter({without("aw", vocab.STREET_STOP_WORDS)}, lambda t: length(t) >= 4 AND {ALPHA}) AS street,
  {by_length(f"list_filter({without('aw', vocab.ADDRESS_STOP_WORDS)}, lambda t: length(t) >= 4 AND {ALPHA})")}[1:2] AS longest
  FROM parts1)"""

KEY_SQL = {
    "a": "CASE WHEN nn <> '' THEN country || '|' || nn END",
    "b": "CASE WHEN nn <> '' AND len(nums) > 0 THEN country || '|' || left(nn, 4) || '|' || array_to_string(nums, '_') END",
    "c": "CASE WHEN len(nums) > 0 AND len(alpha) > 0 THEN country || '|' || nums[1] || '_' || alpha[1] END",
    "d": "CASE WHEN len(sig) > 0 THEN country || '|' || sig[1] END",
    "e": "CASE WHEN nn <> '' AND len(nums) > 0 THEN country || '|' || left(nn, 5) || '|' || array_to_string(nums, '_') END",
    "f": "CASE WHEN len(street) > 1 THEN country || '|' || street[1] || '|' || street[2] END",
    "g": "CASE WHEN len(sig) > 1 THEN country || '|' || least(sig[1], sig[2]) || '|' || greatest(sig[1], sig[2]) END",
    "h": "CASE WHEN len(sig) > 1 THEN country || '|' || sig[2] END",
    "i": "CASE WHEN len(longest) > 1 THEN country || '|' || least(longest[1], longest[2]) || '|' || greatest(longest[1], longest[2]) END",
}


def key_table(names: tuple[str, ...]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS key_type, {KEY_SQL[n]} AS key, entity_id, source, ord FROM parts" for n in names
    )
    return f"keyed AS (SELECT DISTINCT * FROM ({rows}) WHERE key IS NOT NULL)"


def postings(caps: dict[str, int]) -> str:
    limit = "CASE key_type " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in caps.items()) + " ELSE 1000000000 END" if caps else "1000000000"
    return f"""posted AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key_type, key ORDER BY ord, entity_id) AS rn
  FROM keyed WHERE source <> 'S1') WHERE rn <= {limit})"""


FLAGS = ("a", "b", "c", "d", "f", "g", "i")


def evidence(names: tuple[str, ...], caps: dict[str, int]) -> str:
    flags = ", ".join(f"bool_or(s.key_type = '{f}') AS has_{f}" for f in FLAGS)
    count = " + ".join(f"has_{f}::INT" for f in FLAGS)
    return f"""WITH {RECORDS}, {PARTS}, {key_table(names)}, {postings(caps)},
ev0 AS (SELECT s.entity_id AS s1_id, p.entity_id AS target_id, {flags} FROM keyed s JOIN posted p USING (key_type, key)
  WHERE s.source = 'S1' GROUP BY 1, 2),
ev AS (SELECT *, ({count})::INT AS evidence_count FROM ev0)"""


def ranked(names: tuple[str, ...], caps: dict[str, int], weights: dict[str, float], bonus: float) -> str:
    score = " + ".join(f"has_{f}::INT * {w}::DOUBLE" for f, w in weights.items())
    return f"""{evidence(names, caps)},
scored AS (SELECT *, {score} + greatest(evidence_count - 1, 0) * {bonus}::DOUBLE AS score FROM ev),
rk AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, evidence_count DESC, target_id)::INT AS rank
  FROM scored)"""


TRUTH = """truth AS (SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS target_id FROM rec a JOIN rec b USING (content)
  WHERE a.source = 'S1' AND b.source <> 'S1')"""
SCOPE = "scope AS (SELECT entity_id AS s1_id, country FROM rec WHERE source = 'S1')"

F05 = "CASE WHEN 0.25 * precision + recall = 0 THEN 0.0 ELSE 1.25 * precision * recall / (0.25 * precision + recall) END"


def confusion(found: str) -> str:
    """CTEs truth, scope, conf and scores, of a CTE `found` (s1_id, target_id)."""
    return f"""{TRUTH}, {SCOPE}, found AS ({found}),
conf AS (SELECT s.s1_id, s.country, coalesce(t.n, 0) AS n_true, coalesce(p.n, 0) AS n_found, coalesce(r.n, 0) AS n_right FROM scope s
  LEFT JOIN (SELECT s1_id, count(*) AS n FROM truth GROUP BY 1) t USING (s1_id)
  LEFT JOIN (SELECT s1_id, count(*) AS n FROM found GROUP BY 1) p USING (s1_id)
  LEFT JOIN (SELECT s1_id, count(*) AS n FROM found JOIN truth USING (s1_id, target_id) GROUP BY 1) r USING (s1_id)),
pr AS (SELECT *, CASE WHEN n_true = 0 AND n_found = 0 THEN 1.0 WHEN n_found = 0 THEN 0.0 ELSE n_right / n_found END::DOUBLE AS precision,
  CASE WHEN n_true = 0 AND n_found = 0 THEN 1.0 WHEN n_true = 0 THEN 0.0 ELSE n_right / n_true END::DOUBLE AS recall FROM conf),
scores AS (SELECT *, {F05} AS f05 FROM pr)"""


LAND = "CASE country " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in entities.LANDS.items()) + " ELSE country END"


def tier_parts(suffixes: list[str]) -> str:
    """CTE tp: what tiers are made of."""
    place = lambda ps: f"coalesce(list_min(list_filter(regexp_extract_all(lower(address), '[a-z]+'), lambda t: list_contains({words(ps)}, t))), '')"
    return rf"""tp0 AS (SELECT entity_id, source, ord, address, {LAND} AS land, {clean_name("name", suffixes)} AS cn FROM rec),
tp1 AS (SELECT *, split_part(cn, ' ', 1) AS w1, replace(cn, ' ', '') AS cond, regexp_extract(address, '\b\d+\b') AS num,
  list_filter(string_split(cn, ' '), lambda t: length(t) >= 4) AS words4,
  CASE land WHEN 'india' THEN {place(entities.PLACES_INDIA)} WHEN 'france' THEN {place(entities.PLACES_FRANCE)} ELSE '' END AS geo FROM tp0),
tp AS (SELECT *, CASE WHEN length(w1) >= 3 THEN left(w1, 3) ELSE '' END AS tri FROM tp1)"""


def cascade(tiers: list[dict], most: int, suffixes: list[str]) -> str:
    rows = []
    for i, t in enumerate(tiers, 1):
        ok = " AND ".join(f"{p} <> ''" for p in t["parts"] if p != "word") or "TRUE"
        key = " || '|' || ".join(["land", *t["parts"]])
        if t.get("multi"):
            source = "(SELECT *, unnest(words4) AS word, generate_subscripts(words4, 1) - 1 AS pos FROM tp)"
        else:
            source = "(SELECT *, 0 AS pos FROM tp)"
        rows.append(f"SELECT entity_id, source, ord, {i} AS tier, pos, {key} AS key FROM {source} WHERE {ok}")
    rare = " ".join(f"WHEN {i} THEN {t['rare']}" for i, t in enumerate(tiers, 1) if t.get("rare"))
    limit = f"CASE tier {rare} ELSE 1000000000 END"
    resort = [str(i) for i, t in enumerate(tiers, 1) if t.get("last_resort")]
    last = f"AND (tier NOT IN ({', '.join(resort)}) OR best = tier)" if resort else ""
    return f"""WITH {RECORDS}, {tier_parts(suffixes)}, tk AS ({" UNION ALL ".join(rows)}),
tt AS (SELECT DISTINCT tier, key, entity_id, ord FROM tk WHERE source <> 'S1'),
tr AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY tier, key) AS bucket FROM tt) WHERE bucket <= {limit}),
hits AS (SELECT s.entity_id AS s1_id, t.entity_id AS target_id, min({{'tier': s.tier, 'pos': s.pos, 'ord': t.ord}}) AS h
  FROM tk s JOIN tr t USING (tier, key) WHERE s.source = 'S1' GROUP BY 1, 2),
placed AS (SELECT s1_id, target_id, h.tier AS tier,
  row_number() OVER (PARTITION BY s1_id ORDER BY h.tier, h.pos, h.ord, target_id)::INT AS place,
  min(h.tier) OVER (PARTITION BY s1_id) AS best FROM hits)
SELECT s1_id, target_id, tier, place FROM placed WHERE (tier = 1 OR place <= {most}) {last}"""
