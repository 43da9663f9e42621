"""The manifest of op11 in DuckDB SQL."""

SQL = r"""
WITH RECURSIVE bits(b, k, c) AS (
    SELECT b, 0, b FROM range(256) AS t(b)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc(doc_id, pos, c) AS (
    SELECT DISTINCT doc_id, 0, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, pos + 1, xor(crc.c >> 8, bits.c)
    FROM crc JOIN bits ON k = 8 AND b = xor(crc.c & 255, ord(substr(doc_id::VARCHAR, pos + 1, 1)))
    WHERE pos < strlen(doc_id::VARCHAR)
), chosen AS (
    SELECT doc_id FROM crc WHERE pos = strlen(doc_id::VARCHAR) AND xor(c, 4294967295) % 3 = 0
), fields AS (
    SELECT doc_id, lang, text,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS others,
        CASE WHEN doc_id IN (SELECT doc_id FROM chosen)
            THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed
    FROM documents
), leaves AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree,
        sha256(others || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(others || coalesce(strlen(changed) || ':' || changed, '-')) AS altered
    FROM fields
), placed AS (
    SELECT *, row_number() OVER () AS row,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM leaves
), low(tree, level, place, digest, size) AS (
    SELECT tree, 0, place, leaf, count(*) OVER (PARTITION BY tree) FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (size + 7) // 8
    FROM low WHERE size > 1 GROUP BY tree, level, size, place // 8
), subroots AS (
    SELECT tree, digest, level AS height, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE size = 1
), high(level, place, digest, size) AS (
    SELECT 0, place, digest, count(*) OVER () FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (size + 7) // 8
    FROM high WHERE size > 1 GROUP BY level, size, place // 8
), ways AS (
    SELECT row, altered, p.place, s.place AS above, s.digest AS subroot, height, p.tree
    FROM placed p JOIN subroots s ON p.tree = s.tree
), beside AS (
    SELECT row, level AS step, n.place < w.place // (8 ** level)::BIGINT AS is_before, n.place, n.digest
    FROM ways w JOIN low n ON n.tree = w.tree AND level < height
        AND n.place // 8 = w.place // (8 ** (level + 1))::BIGINT AND n.place <> w.place // (8 ** level)::BIGINT
    UNION ALL
    SELECT row, height + level, n.place < above // (8 ** level)::BIGINT, n.place, n.digest
    FROM ways w JOIN high n ON size > 1
        AND n.place // 8 = above // (8 ** (level + 1))::BIGINT AND n.place <> above // (8 ** level)::BIGINT
), steps AS (
    SELECT row, step, coalesce(string_agg(digest, '' ORDER BY place) FILTER (is_before), '') AS before,
        coalesce(string_agg(digest, '' ORDER BY place) FILTER (NOT is_before), '') AS after
    FROM beside GROUP BY row, step
), heights AS (
    SELECT row, altered, subroot, height + (SELECT max(level) FROM high) AS top FROM ways
), fold(row, step, digest, top) AS (
    SELECT row, 0, altered, top FROM heights
    UNION ALL
    SELECT f.row, f.step + 1, sha256(coalesce(before, '') || digest || coalesce(after, '')), top
    FROM fold f LEFT JOIN steps s ON s.row = f.row AND s.step = f.step WHERE f.step < top
), proofs AS (
    SELECT row, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY row
), ends AS (
    SELECT digest AS root FROM high WHERE size = 1
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.digest AS folded_root,
    f.digest = root AS verified
FROM placed p JOIN heights h ON h.row = p.row JOIN fold f ON f.row = p.row AND f.step = f.top
    LEFT JOIN proofs o ON o.row = p.row JOIN ends ON true
"""
