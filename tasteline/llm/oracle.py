"""SQL of the queries that SQL can express, for DuckDB."""

from tasteline.llm.licenses import scan_sql

OP3 = """
WITH docs AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text) NULLS FIRST, source NULLS FIRST) - 1 AS number
    FROM documents
), drawn AS (
    SELECT *, CAST('0x' || substr(md5('17-' || number), 1, 15) AS BIGINT) AS draw FROM docs
), sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), ranked AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM sums
), filled AS (
    SELECT *,
           coalesce(sum(cap) OVER before, 0) AS caps,
           sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
           sum(source_size) OVER () AS total
    FROM ranked
    WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT CAST(total - caps AS DOUBLE) / CAST(weights AS DOUBLE) AS level, cap, weight, cap / weight AS place, source
    FROM filled
), level AS (
    SELECT level FROM levels WHERE level * weight <= cap ORDER BY place, source LIMIT 1
), targets AS (
    SELECT source, source_size,
           CASE WHEN level * weight > cap THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target
    FROM ranked, level
), shares AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
    FROM targets
), rests AS (
    SELECT *, target - whole * source_size AS rest FROM shares
), placed AS (
    SELECT d.doc_id, d.size, d.number, d.draw, r.*,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.number) AS upto
    FROM drawn d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
), lasts AS (
    SELECT source, min(CASE WHEN upto > rest THEN (draw, number) END) AS cut,
           coalesce(max(CASE WHEN upto <= rest THEN upto END), 0) AS got
    FROM placed GROUP BY source
), taken AS (
    SELECT p.*, l.cut, p.rest - l.got AS missing,
           (l.cut IS NULL OR (p.draw, p.number) < l.cut) AS below
    FROM placed p JOIN lasts l ON p.source IS NOT DISTINCT FROM l.source
), near AS (
    SELECT *, CASE WHEN NOT below AND abs(size - missing) < missing THEN
           row_number() OVER (PARTITION BY source, below OR abs(size - missing) >= missing
                              ORDER BY abs(size - missing), draw, number) END AS place
    FROM taken
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * least(whole + CASE WHEN below OR coalesce(place, 0) = 1 THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM near
"""

OP4 = """
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS seq
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)
), least AS (
    SELECT seq, min(doc_id) AS first_id FROM windows GROUP BY seq
), gone AS (
    SELECT DISTINCT doc_id, place
    FROM (SELECT w.doc_id, unnest(range(w.i, w.i + 13)) AS place
          FROM windows w JOIN least l ON w.seq = l.seq WHERE l.first_id < w.doc_id)
), removed AS (
    SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN w ELSE
           list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w[i]) END, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id)
"""

OP10 = """
WITH lowered AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), sized AS (
    SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0
), patterns AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS pattern
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), lengths AS (
    SELECT DISTINCT n FROM sized
), windows AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS pattern
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lowered, lengths)
), found AS (
    SELECT doc_id, windows.n, i, item_id FROM windows JOIN patterns USING (pattern, n)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP8 = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), words AS (
    SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs
), pairs AS (
    SELECT doc_id, word, coalesce(lag(word) OVER (PARTITION BY r ORDER BY i), '') AS before FROM words
), one AS (
    SELECT word, count(*) AS n FROM words GROUP BY word
    UNION ALL SELECT '' AS word, count(*) AS n FROM words WHERE i = 0
), two AS (
    SELECT before, word, count(*) AS n FROM pairs GROUP BY before, word
), total AS (
    SELECT count(*) AS n FROM words
), scores AS (
    SELECT two.before, two.word, two.n > 1 AS known,
           CAST(round(1000000 * ln(CASE WHEN two.n > 1 THEN CAST(two.n - 1 AS DOUBLE) / CAST(b.n - 1 AS DOUBLE)
               ELSE 0.4 * CAST(greatest(l.n - 1, 1) AS DOUBLE) / CAST(greatest(total.n - 1, 1) AS DOUBLE) END)) AS BIGINT) AS score
    FROM two JOIN one b ON two.before = b.word JOIN one l ON two.word = l.word, total
), sums AS (
    SELECT p.doc_id, count(*) AS n_words, CAST(sum(CASE WHEN known THEN 1 ELSE 0 END) AS BIGINT) AS n_known,
           CAST(sum(score) AS BIGINT) AS log_score
    FROM pairs p JOIN scores s ON p.before = s.before AND p.word = s.word GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_known, 0) AS n_known, coalesce(log_score, 0) AS log_score,
       CASE WHEN n_words > 0 THEN round(exp(-(CAST(log_score AS DOUBLE) / n_words / 1000000)), 4) END AS perplexity
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN sums s ON d.doc_id IS NOT DISTINCT FROM s.doc_id
"""

ORACLE_SQL = {"op3_source_mix": OP3, "op4_repeated_passages": OP4, "op5_licence_scan": scan_sql(), "op8_lm_scores": OP8, "op10_decontamination": OP10}
