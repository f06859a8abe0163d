"""SQL over the raw tables for the queries that SQL can express."""

WORDS = r"[^\x20\x09-\x0D]+"

OP4 = rf"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(COALESCE(LENGTH(REGEXP_EXTRACT_ALL(text, '{WORDS}')), 0) AS BIGINT) AS size,
         CAST('0x' || SUBSTR(MD5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':17'), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, 2.0::DOUBLE * SUM(size) AS cap,
         LIST_EXTRACT([5.0::DOUBLE, 2.0, 1.0], CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) AS weight
  FROM sized GROUP BY source),
steps AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY cap / weight, source NULLS LAST) AS k,
         SUM(source_size) OVER () AS total,
         COALESCE(SUM(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         SUM(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM sources),
level AS (
  SELECT ARG_MIN((1.5::DOUBLE * total - cap_before) / weight_left, k) AS level FROM steps
  WHERE cap / weight > (1.5::DOUBLE * total - cap_before) / weight_left),
targets AS (
  SELECT source, source_size, LEAST(cap, weight * COALESCE((SELECT level FROM level), 0)) AS target FROM sources),
placed AS (
  SELECT doc_id, source, size,
         SUM(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized),
planned AS (
  SELECT doc_id, p.source, size, source_size, target, start, CAST(FLOOR(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(FLOOR(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, CAST(epochs AS BIGINT) AS epochs,
       CAST(epochs * size + LEAST(size, GREATEST(0, budget - epochs * source_size - start)) AS BIGINT) AS taken
FROM planned
"""

OP6 = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS payload, SHA1(COALESCE(html, '')) AS h FROM pages),
g AS (SELECT payload, MAX(page_id) AS response FROM p GROUP BY payload)
SELECT page_id, CAST(OCTET_LENGTH(ENCODE(p.payload)) AS BIGINT) AS payload_bytes,
       LIST_AGGREGATE(LIST_TRANSFORM(RANGE(0, 32), lambda i: SUBSTR('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || SUBSTR(h, CAST(1 + (i // 4) * 5 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM p JOIN g USING (payload)
"""

OP13 = """
WITH numbered AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * CAST(x AS DOUBLE))) AS whole
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id,
         CAST(LIST_DOT_PRODUCT(a.whole, b.whole) AS BIGINT) AS score
  FROM numbered a JOIN numbered b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT s.anchor_id, p.positive_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY s.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM scored s JOIN positives p ON p.anchor_id = s.anchor_id
WHERE NOT s.alike AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

ORACLES = {"op4_source_mixing": OP4, "op6_warc_zip": OP6, "op13_hard_negatives": OP13}
