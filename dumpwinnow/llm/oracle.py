"""DuckDB SQL for the queries that SQL can express on whole tables.

Scores, trees, network weights, shards, runs of words and fingerprints are not among them; tests
compare those with brute force.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(table: str, key: str, pattern: str, fold: bool) -> str:
    """One row for each word: key, place i from 1, word w."""
    text = f"translate(text, '{UPPER}', '{LOWER}')" if fold else "text"
    return f"""
        SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
        FROM (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS ws FROM {table})"""


def next_words(key: str, size: int) -> str:
    return f"PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING"


NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS ({words("documents", "doc_id", SPACED, True)}),
grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id) AS n,
           count(*) OVER near AS size, string_agg(w, ' ') OVER near AS g
    FROM words WINDOW near AS ({next_words("doc_id", 3)})),
sets AS (SELECT DISTINCT doc_id, g FROM grams WHERE size = 3 OR (n < 3 AND i = 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
    SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c.n >= 85 * (p.n + q.n - c.n)),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT doc_id, y FROM reach JOIN links ON other = x),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

CONTAMINATION = f"""
WITH words AS ({words("documents", "doc_id", ALPHANUMERIC, True)}),
item_words AS ({words("benchmark", "item_id", ALPHANUMERIC, True)}),
windows AS (
    SELECT DISTINCT item_id, ws FROM (
        SELECT item_id, i, list(w) OVER near AS ws, count(*) OVER (PARTITION BY item_id) AS n
        FROM item_words WINDOW near AS ({next_words("item_id", 13)}))
    WHERE len(ws) = 13 OR (n < 13 AND i = 1)),
lengths AS (SELECT DISTINCT len(ws) AS n FROM windows),
ahead AS (
    SELECT doc_id, i, list(w) OVER near AS ws
    FROM words WINDOW near AS ({next_words("doc_id", 13)})),
found AS (
    SELECT doc_id, i, item_id, n
    FROM (SELECT doc_id, i, n, ws[1:n] AS ws FROM ahead JOIN lengths ON len(ws) >= n)
    JOIN windows USING (ws)),
hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n, 0) AS contaminated
FROM documents LEFT JOIN counts USING (doc_id) LEFT JOIN hit USING (doc_id)
LEFT JOIN items USING (doc_id)"""

REVISITS = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
tops AS (
    SELECT *, strlen(payload) >= 1000 AND page_id < max(page_id) OVER same AS again,
           max(page_id) OVER same AS top
    FROM payloads WINDOW same AS (PARTITION BY payload))
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to
FROM tops"""

WINDOWS = f"""
WITH words AS ({words("documents", "doc_id", SPACED, False)}),
ahead AS (
    SELECT doc_id, i, w, count(*) OVER near AS size, sha256(string_agg(w, ' ') OVER near) AS h
    FROM words WINDOW near AS ({next_words("doc_id", 50)})),
first AS (SELECT h, min(doc_id) AS f FROM ahead WHERE size = 50 GROUP BY h),
marked AS (
    SELECT doc_id, i, w,
           coalesce(max(CASE WHEN size = 50 AND f < doc_id THEN 1 END) OVER (
               PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM ahead LEFT JOIN first USING (h)),
kept AS (
    SELECT doc_id, count(*) AS n, sum(gone) AS gone,
           string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS text
    FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
           CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
negatives AS (
    SELECT anchor_id, positive_id, CAST(row_number() OVER first AS INTEGER) AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW first AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))
SELECT * FROM negatives WHERE rank <= 3"""

SUFFIXES = """
WITH raw AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (  -- 400 bytes each, with the 400 that follow
    SELECT doc_id, n, k, substr(h, 800 * k + 1, 1600) AS block
    FROM (SELECT *, strlen(h) // 2 AS n, unnest(range(0, strlen(h) // 800 + 1)) AS k FROM raw)),
bytes AS (
    SELECT doc_id, n, 400 * k + j AS i, block, j
    FROM (SELECT *, unnest(range(0, 400)) AS j FROM blocks) WHERE 400 * k + j < n),
starts AS (
    SELECT doc_id, i, md5(substr(block, 2 * j + 1, 800)) AS w FROM bytes WHERE i + 400 <= n),
again AS (SELECT w FROM starts GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, i, 1 AS hit FROM starts JOIN again USING (w)),
marked AS (
    SELECT doc_id, i, substr(block, 2 * j + 1, 2) AS b,
           coalesce(max(hit) OVER (
               PARTITION BY doc_id ORDER BY i ROWS BETWEEN 399 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM bytes LEFT JOIN hit USING (doc_id, i)),
edges AS (
    SELECT *, gone = 1 AND lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) = 0 AS head
    FROM marked),
cut AS (
    SELECT doc_id, count(*) AS n, sum(gone) AS gone, count(*) FILTER (head) AS spans,
           string_agg(b, '' ORDER BY i) FILTER (gone = 0) AS kept
    FROM edges GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM documents LEFT JOIN cut USING (doc_id)"""
