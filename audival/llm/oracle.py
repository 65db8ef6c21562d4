"""DuckDB statements for the text operators that SQL can express."""

from __future__ import annotations

_WHITE = r"[\x20\x09-\x0D]"

#: Brute force: all pairs that share a shingle, then the closure of the links.
OP1 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
size AS (SELECT doc_id, count(s) AS n FROM d LEFT JOIN shingle USING (doc_id) GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
        FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM met JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
         WHERE 100 * k >= 75 * (a.n + b.n - k)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM size
  UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN size USING (doc_id) GROUP BY doc_id
"""

OP4 = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '{_WHITE}', '', 'g') AS content
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS kept,
       sha256(content) AS text_sha256
FROM d
"""

OP5 = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM pattern),
place AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM low, sizes WHERE len(w) >= m)),
found AS (SELECT DISTINCT doc_id, m, i, item_id FROM place JOIN pattern USING (m, p)),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + m)) AS x FROM (SELECT DISTINCT doc_id, i, m FROM found))
            GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT low.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM low LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP6 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT s, min(doc_id) AS lo FROM wins GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
         FROM wins JOIN firsts USING (s) WHERE doc_id > lo),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""

STATEMENTS: dict[str, str] = {
    "op1_near_dedup": OP1,
    "op4_exact_dedup": OP4,
    "op5_decontaminate": OP5,
    "op6_substring_dedup": OP6,
    "op12_negatives": OP12,
}
