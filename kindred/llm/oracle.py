"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from kindred.llm import mixing, urls, warc

WORDS = r"[^\x20\x09-\x0D]+"

#: Least node reachable over links (a, b) in both directions, for every row of nodes (node).
_REACH = """reach AS (WITH RECURSIVE r(node, to_) AS (SELECT node, node FROM nodes UNION SELECT r.node, l.b FROM r JOIN links l ON r.to_ = l.a)
  SELECT node, min(to_) AS component_id FROM r GROUP BY 1)"""

OP2 = f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
nodes AS (SELECT vec_id AS node FROM v), {_REACH}, n AS (SELECT a AS node, count(*) AS n FROM links GROUP BY 1)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept FROM reach LEFT JOIN n USING (node)"""

OP3 = f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM q WHERE payload_bytes >= {warc.LEAST_REVISIT} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM q LEFT JOIN f USING (payload_digest)"""

OP4 = rf"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS size, length(text) AS chars FROM documents),
k AS (SELECT *, -ln((('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
  / CASE WHEN chars / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i FROM k GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][i % 3 + 1] AS w, 2.0::DOUBLE * source_size AS cap FROM s),
o AS (SELECT *, cap / w AS ratio FROM w),
l AS (SELECT *, ((SELECT 1.5::DOUBLE * sum(source_size) FROM o) - coalesce(sum(cap) OVER u, 0)) / ((SELECT sum(w) FROM o) - coalesce(sum(w) OVER u, 0)) AS level
  FROM o WINDOW u AS (ORDER BY ratio, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, w * (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, i LIMIT 1)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (SELECT *, round(target - epochs * source_size)::BIGINT AS rest FROM e),
p AS (SELECT k.*, r.source_size, r.target, r.epochs, r.rest, coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - ahead)))::BIGINT AS taken FROM p"""

OP6 = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '{WORDS}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT c.a, c.b FROM c JOIN s p ON p.doc_id = c.a JOIN s q ON q.doc_id = c.b WHERE 100 * n >= 90 * (len(p.g) + len(q.g) - n)),
nodes AS (SELECT doc_id AS node FROM s), {_REACH}
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN reach ON node = doc_id"""


def op8(rules: list[urls.Rule], default: str = "allow") -> str:
    values = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    return rf"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
a AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS auth FROM u),
h AS (SELECT page_id, coalesce(translate(auth, '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
  coalesce(regexp_extract(substr(rest, length(auth) + 1), '^[^?#]*'), '') AS path FROM a),
rules(verdict, rhost, rpath) AS (VALUES {values})
SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, coalesce(arg_max(verdict, length(rhost || rpath)), '{default}') AS verdict
FROM h LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id, host, path"""
