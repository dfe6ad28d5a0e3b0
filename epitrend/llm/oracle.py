"""DuckDB SQL of the queries that SQL can express by their definition."""

from __future__ import annotations

# Components of ``links (x, y)`` over the ids of ``ids (id)``: everything
# reachable from an id, and the smallest of it.
_COMPONENTS = """
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, node) AS (
  SELECT id, id FROM ids
  UNION
  SELECT r.id, b.y FROM reach r JOIN both_ways b ON r.node = b.x),
component AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE
           WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingle a JOIN shingle b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
  WHERE 100 * c >= 85 * (a.n + b.n - c)),
ids AS (SELECT DISTINCT doc_id AS id FROM documents),""" + _COMPONENTS + """
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.id = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
ids AS (SELECT DISTINCT vec_id AS id FROM embeddings),""" + _COMPONENTS + """,
degree AS (SELECT x, count(*) AS n FROM both_ways GROUP BY x)
SELECT t.vec_id, CAST(coalesce(g.n, 0) AS BIGINT) AS n_links, c.component_id,
       t.vec_id = c.component_id AS kept
FROM embeddings t JOIN component c ON c.id = t.vec_id LEFT JOIN degree g ON g.x = t.vec_id"""

NEIGHBOURS = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pair AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_distance(a.e, b.e) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS r FROM pair)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
positive AS (
  SELECT anchor_id, id, s FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) AS r FROM pair WHERE same)
  WHERE r <= 5),
negative AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.s DESC, n.id) AS r
  FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
  WHERE 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE r <= 5"""

# Texts as hexadecimal bytes, two digits a byte. Repeated starts at most 200
# apart cover one run of bytes.
REPEATED_STRINGS = """
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pos AS (
  SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 199)) AS s FROM raw),
strings AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 400)) AS k FROM pos),
again AS (SELECT k FROM strings GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, s FROM strings SEMI JOIN again USING (k)),
step AS (SELECT *, CASE WHEN s - lag(s) OVER w <= 200 THEN 0 ELSE 1 END AS fresh
         FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM step),
span AS (SELECT doc_id, r, min(s) AS a, max(s) + 200 AS b FROM run GROUP BY doc_id, r),
gap AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL
  SELECT x.doc_id, coalesce(max(y.b), 0), CAST(length(any_value(x.h)) / 2 AS BIGINT)
  FROM raw x LEFT JOIN span y ON x.doc_id = y.doc_id GROUP BY x.doc_id),
kept AS (
  SELECT g.doc_id, string_agg(substr(x.h, 2 * g.a + 1, 2 * (g.b - g.a)), '' ORDER BY g.a) AS h
  FROM gap g JOIN raw x ON x.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT x.doc_id, CAST(length(x.h) / 2 AS BIGINT) AS n_bytes,
       CAST((length(x.h) - length(k.h)) / 2 AS BIGINT) AS n_removed,
       (SELECT count(*) FROM span s WHERE s.doc_id = x.doc_id) AS n_spans,
       sha256(unhex(k.h)) AS kept_sha256
FROM raw x JOIN kept k ON k.doc_id = x.doc_id"""
