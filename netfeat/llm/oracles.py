"""DuckDB SQL for the queries that SQL can express, from their definitions."""

from __future__ import annotations

from netfeat.llm import backoff, caps, secrets, sources_audit

WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"


def _classes(nodes: str, edges: str) -> str:
    """CTE ``cc`` (id, c): smallest id that ``edges`` (a, b), in both directions, reach from each of ``nodes``."""
    return f"""cc(id, c) USING KEY (id) AS (
  SELECT id, id FROM {nodes}
  UNION
  (SELECT x.id, min(x.c) FROM (SELECT e.a AS id, cc.c FROM cc JOIN {edges} e ON e.b = cc.id) x
   JOIN recurring.cc r ON r.id = x.id WHERE x.c < r.c GROUP BY x.id))"""


NGRAM_JOIN = f"""WITH RECURSIVE
w AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT id, g FROM (
    SELECT id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY ALL),
e AS (SELECT p.a, p.b, p.c = na.n AND p.c = nb.n AS same FROM p JOIN n na ON na.id = p.a JOIN n nb ON nb.id = p.b
      WHERE 5 * p.c >= 4 * (na.n + nb.n - p.c)),
{_classes("w", "e")}
SELECT w.id AS doc_id, cc.c AS class_id, coalesce(l.n, 0) AS n_links, least(w.id, coalesce(l.copy, w.id)) AS copy_id
FROM w JOIN cc ON cc.id = w.id
LEFT JOIN (SELECT a, count(*) AS n, min(CASE WHEN same THEN b END) AS copy FROM e GROUP BY a) l ON l.a = w.id"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, group: int = 0) -> str:
    p = _quoted(pattern)
    return f"""SELECT rid, {kind} AS kind, k, v, m, fin - len(m) AS s, fin AS e FROM (
    SELECT *, sum(len(m) + len(gap)) OVER (PARTITION BY rid ORDER BY k ROWS UNBOUNDED PRECEDING) AS fin FROM (
      SELECT rid, unnest(range(len(f))) AS k, unnest(f) AS m, unnest(regexp_extract_all(t, {p}, {group})) AS v,
             unnest(string_split_regex(t, {p})[1:len(f)]) AS gap
      FROM (SELECT rid, t, regexp_extract_all(t, {p}) AS f FROM d) WHERE len(f) > 0))"""


SECRETS = f"""WITH
d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT * FROM ({_matches(0, secrets.ASSIGN, 2)}) WHERE len(v) >= {secrets.LEAST["assign"]}
  UNION ALL SELECT * FROM ({_matches(1, secrets.ACCESS)}) WHERE len(v) >= {secrets.LEAST["access"]}
  UNION ALL SELECT * FROM ({_matches(2, secrets.HEX)}) WHERE len(v) >= {secrets.LEAST["hex"]}),
more AS (
  SELECT * FROM ({_matches(3, secrets.CANDIDATE)}) r
  WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
    AND len(list_distinct(string_split(v, ''))) >= {secrets.LEAST_DIFFERENT}
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND r.s < b.e AND b.s < r.e)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM more),
owners AS (
  SELECT v, count(*) AS n, sum(r) AS r FROM (
    SELECT v, source, count(DISTINCT coalesce('+' || doc_id, '-')) AS r FROM every JOIN d USING (rid) GROUP BY v, source)
  GROUP BY v),
spans AS (
  SELECT x.*, o.n >= {secrets.COPIED_OWNERS} OR o.r >= {secrets.COPIED_REPOSITORIES} AS copied,
         ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS name
  FROM every x JOIN owners o USING (v)),
per AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind < 3 AND copied) AS n_copied,
         string_agg(name, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
         string_agg(name, ',' ORDER BY s, kind) FILTER (kind < 3 OR NOT copied) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (rid)"""


CAPS = f"""WITH RECURSIVE
v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0
  AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0),
e AS (SELECT a.id AS a, b.id AS b FROM good a JOIN good b ON a.label = b.label AND a.id <> b.id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= {caps.COSINE}),
{_classes("v", "e")}
SELECT v.id AS vec_id, coalesce(l.n, 0) AS n_links, cc.c AS component_id, v.id = cc.c AS kept
FROM v JOIN cc ON cc.id = v.id LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY a) l ON l.a = v.id"""


BACKOFF = f"""WITH
w AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents),
t AS (SELECT id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS y, unnest(list_prepend(NULL, w[1:len(w) - 1])) AS x FROM w WHERE len(w) > 0),
u1 AS (SELECT y, count(*) AS n FROM t GROUP BY y), o1 AS (SELECT id, y, count(*) AS n FROM t GROUP BY ALL),
u2 AS (SELECT x, y, count(*) AS n FROM t WHERE k > 1 GROUP BY ALL), o2 AS (SELECT id, x, y, count(*) AS n FROM t WHERE k > 1 GROUP BY ALL),
c AS (
  SELECT t.id, t.k, (SELECT sum(len(w)) FROM w) - len(w.w) AS rest, a.n - b.n AS c1, e.n - f.n AS c2, g.n - h.n AS cx
  FROM t JOIN w ON w.id = t.id JOIN u1 a ON a.y = t.y JOIN o1 b ON b.id = t.id AND b.y = t.y
  LEFT JOIN u2 e ON e.x = t.x AND e.y = t.y LEFT JOIN o2 f ON f.id = t.id AND f.x = t.x AND f.y = t.y
  LEFT JOIN u1 g ON g.y = t.x LEFT JOIN o1 h ON h.id = t.id AND h.y = t.x),
s AS (
  SELECT id, CASE WHEN c2 > 0 THEN ln(c2) - ln(cx)
                  ELSE (CASE WHEN k > 1 THEN ln({backoff.ALPHA}) ELSE 0 END)
                       + (CASE WHEN c1 > 0 THEN ln(c1) - ln(rest) ELSE -ln(rest + 1) END) END AS s,
         NOT coalesce(c2 > 0, false) AND (k > 1 OR c1 = 0) AS backed
  FROM c)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(x.b, 0) AS BIGINT) AS n_backoff,
       round(coalesce(x.s, 0.0), 6) AS score
FROM w LEFT JOIN (SELECT id, sum(s) AS s, sum(CASE WHEN backed THEN 1 ELSE 0 END) AS b FROM s GROUP BY id) x ON x.id = w.id"""


SOURCE_AUDIT = rf"""WITH
d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS whole FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= {sources_audit.MIN_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(whole) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c, 0) + {sources_audit.PRIOR})) // (g.n + {sources_audit.PRIOR} * v) AS p,
         1 + (1000000000::HUGEINT * (whole + {sources_audit.PRIOR})) // (langs.n + {sources_audit.PRIOR} * v) AS q
  FROM g JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= {sources_audit.TOP_TERMS}"""


ORACLE_SQL = {
    "op3_ngram_join": NGRAM_JOIN,
    "op5_secrets": SECRETS,
    "op8_caps": CAPS,
    "op10_backoff": BACKOFF,
    "op13_source_audit": SOURCE_AUDIT,
}
