"""SQL that gives the same rows, for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.content) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS content FROM documents) d
JOIN (
    SELECT coalesce(text, '') AS content, max(doc_id) AS keep_id, count(*) AS group_size
    FROM documents GROUP BY 1
) g ON d.content = g.content
"""

TOPK_SEARCH = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

# Words and targets by their level; a source's documents lie end to end in shuffled order,
# up to three times over, and what lies before the target is taken.
SOURCE_MIX = """
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
        md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM d GROUP BY source
), w AS (
    SELECT *, CAST((place - 1) % 3 + 1 AS DOUBLE) AS weight FROM s
), o AS (
    SELECT *, row_number() OVER (ORDER BY source_size / weight, place) AS nth FROM w
), h AS (
    SELECT *,
        (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM o
), l AS (
    SELECT share AS level FROM h WHERE share * weight < 3 * source_size ORDER BY nth LIMIT 1
), t AS (
    SELECT h.source, place, source_size,
        CASE WHEN level IS NULL OR level * weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE level * weight END AS target
    FROM h LEFT JOIN l ON true
), a AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(target + 0.5) AS BIGINT) AS words,
        coalesce(sum(d.size) OVER (PARTITION BY t.place ORDER BY substr(digest, 1, 3), digest, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(
    greatest(0, least(size, words - start)) + greatest(0, least(size, words - start - source_size))
    + greatest(0, least(size, words - start - 2 * source_size)) AS BIGINT) AS taken
FROM a
"""

HARD_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
    SELECT k.doc_id, line, pos, keeper IS NOT NULL AND keeper <> k.doc_id AS goes FROM k LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

SQL: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_topk_search": TOPK_SEARCH,
    "op6_source_mix": SOURCE_MIX,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_line_dedup": LINE_DEDUP,
}
