"""SQL for the queries that SQL can express."""

LINES = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM texts),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id > s.keeper AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WINDOWS = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS k,
         array_to_string(list_slice(words, w_at, w_at + least(10, len(words)) - 1), ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS w_at FROM item WHERE len(words) > 0)),
place AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS w_at FROM doc),
hit AS (
  SELECT p.doc_id, p.w_at, w.k, w.item_id
  FROM (SELECT p.*, s.k, array_to_string(list_slice(words, w_at, w_at + s.k - 1), ' ') AS phrase
        FROM place p, (SELECT DISTINCT k FROM win) s WHERE w_at + s.k - 1 <= len(words)) p
  JOIN win w ON w.k = p.k AND w.phrase = p.phrase),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(w_at, w_at + k)) AS pos FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


ARCHIVE = r"""
WITH page AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS of FROM page WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN of < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN of < page_id THEN of END AS refers_to
FROM page LEFT JOIN first USING (payload_digest)
"""

#: The components of links (x, y), from both ends, between ids; `many` counts an id's links.
COMPONENTS = r"""
reach AS (
  SELECT id AS x, id AS y FROM node
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
component AS (SELECT x AS id, min(y) AS component_id FROM reach GROUP BY x),
many AS (SELECT x AS id, count(*) AS n_links FROM link GROUP BY x)
"""

NEAR = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ')
         ELSE array_to_string(list_slice(words, w_at, w_at + 3), ' ') END AS said
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS w_at FROM doc WHERE len(words) > 0)),
node AS (SELECT doc_id AS id, count(said) AS n FROM doc LEFT JOIN shingle USING (doc_id) GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b USING (said)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM shared s JOIN node a ON a.id = x JOIN node b ON b.id = y
  WHERE 100 * s.n >= 80 * (a.n + b.n - s.n)),
{COMPONENTS}
SELECT id AS doc_id, n AS n_shingles, component_id, id = component_id AS kept FROM node JOIN component USING (id)
"""

VECTORS = rf"""
WITH RECURSIVE sound AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT id, v, sqrt(list_dot_product(v, v)) AS norm FROM sound),
node AS (SELECT vec_id AS id FROM embeddings),
link AS (
  SELECT a.id AS x, b.id AS y FROM unit a JOIN unit b ON a.id <> b.id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.95),
{COMPONENTS}
SELECT id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, id = component_id AS kept
FROM node JOIN component USING (id) LEFT JOIN many USING (id)
"""

TRIE = r"""
WITH told AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(words ORDER BY turn NULLS FIRST, k) AS ws,
         conv_id - conv_id % 20 AS base,
         xor(list_reduce(  -- crc32 of the decimal id, bit by bit
           list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, b: list_reduce(
             list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
  FROM told GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id,
         list_concat(list_slice(coalesce(b.ks, []), 1, c.h), list_slice(c.ks, c.h + 1, len(c.ks))) AS ks,
         list_concat(list_slice(coalesce(b.ws, []), 1, c.h), list_slice(c.ws, c.h + 1, len(c.ws))) AS ws
  FROM own c LEFT JOIN own b ON b.conv_id = c.base),
place AS (SELECT *, unnest(range(0, len(ks) + 1)) AS depth FROM rebuilt),
member AS (
  SELECT conv_id, depth, array_to_string(list_slice(ks, 1, depth), ',') AS path,
         array_to_string(list_slice(ks, 1, depth - 1), ',') AS up, ws[depth] AS words, depth = len(ks) AS ends FROM place),
node AS (
  SELECT depth, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY depth, path),
kids AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
valued AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN n.depth > 0 THEN (n_convs - 1) * words ELSE 0 END AS saved
  FROM node n LEFT JOIN kids k USING (depth, path)),
below AS (
  SELECT p.depth, p.path, sum(v.saved) AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
  FROM valued v JOIN rebuilt r USING (conv_id)
  JOIN LATERAL (SELECT unnest(range(0, v.depth + 1)) AS depth) a ON true
  JOIN valued p ON p.depth = a.depth AND p.path = array_to_string(list_slice(r.ks, 1, a.depth), ',')
  GROUP BY p.depth, p.path)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN below b USING (depth, path)
LEFT JOIN valued u ON v.depth > 0 AND u.depth = v.depth - 1 AND u.path = v.up
"""


EXACT = r"""
WITH said AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS said FROM documents),
grouped AS (SELECT said, min(doc_id) AS keep_id, count(*) AS group_size FROM said GROUP BY said)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(said) AS text_sha256 FROM said JOIN grouped USING (said)
"""

NEGATIVES = r"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS same,
         CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
  FROM usable a JOIN usable o ON a.vec_id <> o.vec_id AND len(a.v) = len(o.v) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negative AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank
  FROM positive p JOIN scored n
    ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": LINES,
        "op3_warc": ARCHIVE,
        "op4_decontaminate": WINDOWS,
        "op6_near_duplicates": NEAR,
        "op9_embedding_dedup": VECTORS,
        "op11_conversation_trie": TRIE,
        "op12_exact_dedup": EXACT,
        "op13_hard_negatives": NEGATIVES,
    }
