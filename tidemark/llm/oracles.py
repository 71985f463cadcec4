"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_OP8 = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(rhost, rpath, verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT p.page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.k = 1
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_OP11 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
c AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
t AS (SELECT doc_id, unnest(terms) AS term FROM d),
p AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM p, c GROUP BY term, n_docs),
m AS (SELECT doc_id, 100 - 90 + (90 * len(terms) * n_docs) // n_terms AS m FROM d, c),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filter": _OP8, "op11_ranked_search": _OP11}
