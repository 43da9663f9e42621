"""op3, op7 and op9 in DuckDB SQL: every shingle and window of every text is a row."""

NEAR = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
    ) AS words
    FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE
        WHEN len(words) >= 3 THEN [array_to_string(words[i : i + 2], ' ') FOR i IN range(1, len(words) - 1)]
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
        ELSE [] END)) AS shingles
    FROM split
), classes AS (
    SELECT min(doc_id) AS class_id, shingles, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY shingles
), members AS (
    SELECT class_id, n, unnest(shingles) AS shingle FROM classes
), links AS (
    SELECT a.class_id AS one, b.class_id AS other
    FROM members a JOIN members b ON a.shingle = b.shingle AND a.class_id <> b.class_id
    GROUP BY a.class_id, b.class_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT class_id, class_id AS to_id FROM classes
    UNION
    SELECT class_id, other FROM reach JOIN links ON to_id = one
), components AS (
    SELECT class_id, min(to_id) AS component_id FROM reach GROUP BY class_id
)
SELECT
    doc_id,
    len(s.shingles)::BIGINT AS n_shingles,
    coalesce(component_id, doc_id) AS component_id,
    doc_id = coalesce(component_id, doc_id) AS kept,
    coalesce(class_id, doc_id) AS class_id
FROM sets s LEFT JOIN classes c ON s.shingles = c.shingles LEFT JOIN components USING (class_id)
"""

# Bytes are two hexadecimal digits each, so a window of 100 of them is 200 characters.
REPEATS = """
WITH coded AS (
    SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS code FROM documents
), sized AS (
    SELECT doc_id, code, len(code) // 2 AS n FROM coded
), windows AS (
    SELECT doc_id, pos, code[2 * pos + 1 : 2 * pos + 200] AS own
    FROM (SELECT doc_id, code, unnest(range(n - 99)) AS pos FROM sized WHERE n >= 100)
), judged AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY own ORDER BY doc_id, pos) > 1 AS later FROM windows
), reached AS (
    SELECT doc_id, pos, max(CASE WHEN later THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos ROWS 99 PRECEDING) AS last
    FROM (
        SELECT * FROM judged
        UNION ALL
        SELECT doc_id, unnest(range(greatest(n - 99, 0), n)) AS pos, false FROM sized
    )
), bytes AS (
    SELECT doc_id, pos, last IS NOT NULL AS gone, lag(last IS NOT NULL, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS before
    FROM reached
), counts AS (
    SELECT
        doc_id, count_if(gone)::BIGINT AS n_removed, count_if(gone AND NOT before)::BIGINT AS n_spans,
        string_agg(code[2 * pos + 1 : 2 * pos + 2], '' ORDER BY pos) FILTER (NOT gone) AS kept
    FROM bytes JOIN sized USING (doc_id) GROUP BY doc_id
)
SELECT
    doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM sized LEFT JOIN counts USING (doc_id)
"""

SHARED = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, pos, array_to_string(words[pos : pos + 12], ' ') AS own
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM split WHERE len(words) >= 13)
), judged AS (
    SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY own) < doc_id AS later FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM judged WHERE later
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM split
), marked AS (
    SELECT doc_id, pos, word, g.pos IS NOT NULL AS gone FROM placed LEFT JOIN gone g USING (doc_id, pos)
), spans AS (
    SELECT *, lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM marked
), counts AS (
    SELECT
        doc_id, count_if(gone)::BIGINT AS n_removed, count_if(gone AND NOT before)::BIGINT AS n_spans,
        string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
    FROM spans GROUP BY doc_id
)
SELECT
    doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN counts USING (doc_id)
"""
