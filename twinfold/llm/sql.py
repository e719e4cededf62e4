"""DuckDB SQL for the queries that SQL can express."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

DOCUMENT_WORDS = f"""regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP2 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {DOCUMENT_WORDS} AS ws FROM benchmark),
item_window AS (
    SELECT DISTINCT item_id, least(len(ws), 13) AS n, list_slice(ws, i, i + least(len(ws), 13) - 1) AS w
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM item WHERE len(ws) > 0)
),
doc AS (SELECT row_number() OVER () AS r, doc_id, {DOCUMENT_WORDS} AS ws FROM documents),
doc_window AS (
    SELECT r, i, n, list_slice(ws, i, i + n - 1) AS w
    FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
          FROM doc CROSS JOIN (SELECT DISTINCT n FROM item_window) WHERE len(ws) >= n)
),
hit AS (SELECT r, i, n, item_id FROM doc_window JOIN item_window USING (n, w)),
hit_word AS (SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
hit_item AS (SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN hit_word USING (r) LEFT JOIN hit_item USING (r)
"""

OP5 = f"""
WITH normal AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)
"""

OP9 = """
WITH page AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
),
sized AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
        CASE WHEN octet_length(payload) >= 1000
            THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS response_id
    FROM page
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN response_id IS NULL OR page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = response_id THEN NULL ELSE response_id END AS refers_to
FROM sized
"""

OP10 = f"""
WITH url_rule(rule_host, rule_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
cut AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
page AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
)
SELECT page_id, host, path,
    (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM url_rule
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
    coalesce((SELECT arg_max(verdict, length(rule_host || rule_path)) FROM url_rule
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
     'allow') AS verdict
FROM page
"""

SQL: dict[str, str] = {
    "op2_decontamination": OP2,
    "op5_exact_dedup": OP5,
    "op9_warc": OP9,
    "op10_url_rules": OP10,
}
