"""DuckDB SQL for the queries that SQL can express."""

OP1_QUALITY_RULES = r"""
    WITH words AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    grams AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n
        FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
              FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM words))),
    repeats AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT x) AS dups
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM words)
        WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    q AS (
        SELECT w.doc_id, w.source, len(w.w) AS n_words,
               length(regexp_replace(w.text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(l.dups, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines
        FROM words w LEFT JOIN lines l ON l.doc_id = w.doc_id LEFT JOIN repeats r ON r.doc_id = w.doc_id),
    f AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               100 * n_symbols > 10 * word_chars AS r1,
               n_dup_lines >= 2 AND 100 * n_dup_lines > 30 * n_lines AS r2,
               word_chars > 20 * n_words AS r3 FROM q),
    hosts AS (
        SELECT source, count(*) AS n,
               unnest([{'rule': 0, 'f': count(*) FILTER (WHERE base_failed OR r1 OR r2 OR r3)},
                       {'rule': 1, 'f': count(*) FILTER (WHERE r1)},
                       {'rule': 2, 'f': count(*) FILTER (WHERE r2)},
                       {'rule': 3, 'f': count(*) FILTER (WHERE r3)}]) AS x
        FROM f GROUP BY source),
    corpus AS (
        SELECT x.rule AS rule, (sum(x.f) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) AS m,
               var_pop(x.f::DOUBLE / n) AS v FROM hosts GROUP BY x.rule),
    prior AS (
        SELECT rule, m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1e4 END, 1.0), 1e4) AS s
        FROM corpus),
    verdicts AS (
        SELECT h.source, h.x.rule AS rule, (h.x.f + p.m * p.s) / (h.n + p.s) AS rate
        FROM hosts h JOIN prior p ON p.rule = h.x.rule)
    SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed,
           NOT (f.base_failed OR v0.rate >= 0.9 OR (f.r1 AND v1.rate >= 0.02) OR (f.r2 AND v2.rate >= 0.02)
                OR (f.r3 AND v3.rate >= 0.02)) AS kept
    FROM f JOIN verdicts v0 ON v0.rule = 0 AND v0.source IS NOT DISTINCT FROM f.source
           JOIN verdicts v1 ON v1.rule = 1 AND v1.source IS NOT DISTINCT FROM f.source
           JOIN verdicts v2 ON v2.rule = 2 AND v2.source IS NOT DISTINCT FROM f.source
           JOIN verdicts v3 ON v3.rule = 3 AND v3.source IS NOT DISTINCT FROM f.source
"""

OP7_SUBSTRING_DEDUP = r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM words)),
    first AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
    gone AS (
        SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i
        FROM windows JOIN first ON first.s = windows.s WHERE doc_id > least),
    kept AS (
        SELECT a.doc_id, string_agg(a.x, ' ' ORDER BY a.i) AS t
        FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM words) a
             ANTI JOIN gone g ON g.doc_id = a.doc_id AND g.i = a.i
        GROUP BY a.doc_id),
    n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT w.doc_id, len(w.w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
    FROM words w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

OP8_LINE_DEDUP = r"""
    WITH lines AS (
        SELECT doc_id, i, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
        WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
    runs AS (SELECT a.doc_id, a.k, a.x AS x1, b.x AS x2
             FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.k = a.k + 1),
    later AS (SELECT doc_id, k FROM
                (SELECT *, row_number() OVER (PARTITION BY x1, x2 ORDER BY doc_id, k) AS copy FROM runs)
              WHERE copy > 1),
    single AS (SELECT doc_id, k FROM
                (SELECT doc_id, k, x, row_number() OVER (PARTITION BY x ORDER BY doc_id, k) AS copy FROM lines)
              WHERE copy > 1 AND len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 50),
    gone AS (SELECT doc_id, k FROM later UNION SELECT doc_id, k + 1 FROM later UNION SELECT doc_id, k FROM single),
    kept AS (
        SELECT s.doc_id, string_agg(s.x, chr(10) ORDER BY s.i) AS text
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) s
        WHERE NOT EXISTS (SELECT 1 FROM lines l JOIN gone g ON l.doc_id = g.doc_id AND l.k = g.k
                          WHERE l.doc_id = s.doc_id AND l.i = s.i)
        GROUP BY s.doc_id),
    n AS (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id),
    m AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(m.n, 0) AS n_removed,
           CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
    FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id
         LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
