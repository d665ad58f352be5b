"""SQL equivalents for DuckDB of those queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (
  SELECT doc_id, i, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS win
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l)
  WHERE trim(lines[i], ' ') <> '' OR trim(lines[i + 1], ' ') <> '' OR trim(lines[i + 2], ' ') <> ''
),
later AS (
  SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1
),
covered AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM later),
flat AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM l),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n
  FROM flat ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT l.doc_id,
       CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(len(lines), 0)::BIGINT AS n_lines,
       (coalesce(len(lines), 0) - coalesce(kept.n, 0))::BIGINT AS n_removed
FROM l LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATE = """
WITH b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark
),
win AS (
  SELECT item_id, least(len(w), 10) AS n, w[i : i + least(len(w), 10) - 1] AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents
),
runs AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win))
),
hit AS (SELECT doc_id, i, runs.n AS n, item_id FROM runs JOIN win ON runs.run = win.run),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN words USING (doc_id)
"""

# CRC-32 is folded over the bytes of each text with the usual table of 256 remainders.
SHARDING = """
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
),
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(list_reduce(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
             lambda c, h: xor(c >> 8, t[(xor(c, CAST('0x' || h AS BIGINT)) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, crc_table
),
scores AS (
  SELECT doc_id, s, 1 / -ln((CAST('0x' || left(md5(doc_id || ':' || s), 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496) AS score
  FROM documents, (SELECT unnest(range(9)) AS s)
),
chosen AS (
  SELECT doc_id, arg_max(s, (score, -s)) FILTER (s < 8) AS shard, arg_max(s, (score, -s)) AS grown_shard
  FROM scores GROUP BY doc_id
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(doc_id || ':' || text_crc32)) - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM sized JOIN chosen USING (doc_id)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL
    AND list_aggregate(list_transform(embedding, lambda x: abs(x::DOUBLE)), 'max') > 0
    AND list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
first AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM first LEFT JOIN counts USING (vec_id)
"""

# Base 32 of the SHA-1: eight times five hex digits, each four digits of base 32.
WARC = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, upper(sha1(coalesce(html, ''))) AS h FROM pages
),
d AS (
  SELECT page_id, url, n, array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform(range(4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((CAST('0x' || substr(h, CAST(k * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * j AS BIGINT)) & 31) + 1, 1)), '')), '') AS digest
  FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to,
       url AS target_uri
FROM d WINDOW same AS (PARTITION BY digest, n)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INT AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) <= 5
"""

SQL: dict[str, str] = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_sharding": SHARDING,
    "op6_decontaminate": DECONTAMINATE,
    "op10_embedding_dedup": EMBEDDING_DEDUP,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_warc": WARC,
}
