"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_FIVES = " || ".join(
    f"substr(digits, 1 + (((n >> {20 * (1 - i // 4) + 15 - 5 * (i % 4)}) & 31)::INT), 1)" for i in range(8))

ORACLE: dict[str, str] = {
    "op2_warc": rf"""
WITH hashed AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
    FROM pages),
pieces AS (   -- ten hex digits are eight base-32 digits
    SELECT page_id, payload_bytes, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS digits,
           [CAST('0x' || substr(h, 10 * i + 1, 10) AS BIGINT) FOR i IN range(4)] AS ns
    FROM hashed),
coded AS (
    SELECT page_id, payload_bytes, array_to_string([{_FIVES} FOR n IN ns], '') AS payload_digest
    FROM pieces),
placed AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM coded)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM placed
""",
    "op5_minhash_dedup": r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
listed AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
    FROM tokens),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM listed),
flat AS (SELECT doc_id, unnest(s) AS shingle FROM listed),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared_n
    FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared_n >= 85 * (x.n + y.n - shared_n)),
reach(doc_id, near) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.near)
SELECT doc_id, any_value(n) AS n_shingles, min(near) AS component_id, min(near) = doc_id AS kept
FROM reach JOIN sizes USING (doc_id)
GROUP BY doc_id
""",
    "op8_exact_dedup": r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM hashed
WINDOW same AS (PARTITION BY text_sha256)
""",
    "op11_ranked_search": r"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_terms FROM words WHERE len(w) > 0),
lengths AS (SELECT row, doc_id, 75 + ((25 * len(w) * n_docs) // n_terms)::BIGINT AS m FROM words, totals WHERE len(w) > 0),
asked AS (
    SELECT item_id, term, count(*) AS repeats
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL),
postings AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM words)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
    FROM postings, totals GROUP BY term),
scores AS (
    SELECT item_id, doc_id, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM postings JOIN lengths USING (row) JOIN weights USING (term) JOIN asked USING (term)
    GROUP BY item_id, row, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
""",
    "op12_decontamination": r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, words)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
leaked AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN leaked USING (doc_id)
""",
    "op13_divergence": r"""
WITH rows AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
groups AS (SELECT DISTINCT lang, source FROM rows),
uses AS (SELECT row, lang, source, unnest(w) AS term FROM rows),
kept AS (SELECT lang, term, count(*) AS total FROM uses GROUP BY ALL HAVING count(DISTINCT row) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
levels AS (
    SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n
    FROM groups g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM uses GROUP BY ALL) u USING (lang, source, term)),
priced AS (
    SELECT l.lang, source, term, l.n, (1 + (1000000000 * (l.n + 5)::HUGEINT) // (sum(l.n) OVER (PARTITION BY l.lang, source) + 5 * v))::BIGINT AS p,
           (1 + (1000000000 * (total + 5)::HUGEINT) // (langs.n + 5 * v))::BIGINT AS q
    FROM levels l JOIN kept USING (lang, term) JOIN langs ON langs.lang = l.lang),
distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM priced WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
}
