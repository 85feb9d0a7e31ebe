"""DuckDB SQL of the queries that SQL can express."""

QUALITY_RULES = r"""
WITH words AS (
    SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], chr(1)) AS win
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM words WHERE len(w) >= 8)
),
repeated AS (
    SELECT doc_id, unnest(i_all) AS i FROM (SELECT doc_id, win, list(i) AS i_all FROM windows GROUP BY doc_id, win HAVING count(*) > 1)
),
covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM repeated, (SELECT unnest(generate_series(0, 7)) AS j) GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
m AS (
    SELECT w.doc_id, w.source, CAST(len(w.w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM words w LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
),
failed AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        10 * n_symbols > n_words AS f2, 10 * n_dup_lines > 3 * n_lines AS f3,
        word_chars < 2 * n_words OR word_chars > 15 * n_words AS f4
    FROM m
),
fails AS (
    SELECT source, rule, count(*) AS n, sum(CAST(fail AS INT)) AS k
    FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([base_failed, f2, f3, f4]) AS fail FROM failed) GROUP BY source, rule
),
moments AS (SELECT rule, count(*) AS d, avg(k / n) AS mu, var_samp(k / n) AS v FROM fails GROUP BY rule),
prior AS (
    SELECT rule,
        CASE WHEN d < 2 OR v = 0 OR v >= mu * (1 - mu) THEN mu + 1e-6 ELSE mu * (mu * (1 - mu) / v - 1) END AS a,
        CASE WHEN d < 2 OR v = 0 OR v >= mu * (1 - mu) THEN 1 - mu + 1e-6 ELSE (1 - mu) * (mu * (1 - mu) / v - 1) END AS b
    FROM moments
),
verdict AS (
    SELECT source, bool_or((k + a) / (n + a + b) > a / (a + b) + 3 * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1))) AS domain_failed
    FROM fails JOIN prior USING (rule) GROUP BY source
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, domain_failed,
    NOT base_failed AND NOT domain_failed AS kept
FROM failed f JOIN verdict v ON f.source IS NOT DISTINCT FROM v.source
"""

URL_FILTERS = r"""
WITH p AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
rules(h, pre, v) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
judged AS (
    SELECT page_id, host, path, (
        SELECT max({'n': length(h || pre), 'rule': h || pre, 'v': v}) FROM rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre)
    ) AS best FROM p
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM judged
"""

# Lengths of the template's marks by role: an opening or a joining mark and, for the last turn of a run, the closing one.
CHAT_FORMATTING = r"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
runs AS (
    SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 AS joins,
        lead(role) OVER w IS DISTINCT FROM role AS ends
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
marked AS (
    SELECT *, length(text) + 3 * (length(text) - length(replace(text, '<', ''))) + 4 * (length(text) - length(replace(text, '&', '')))
            + 4 * (length(text) - length(replace(text, '[', ''))) AS chars,
        CASE role WHEN 'system' THEN 5 WHEN 'user' THEN 6 WHEN 'assistant' THEN 3 ELSE 7 + length(role) END AS mark,
        CASE role WHEN 'system' THEN 6 WHEN 'user' THEN 7 WHEN 'assistant' THEN 4 ELSE 7 END AS close
    FROM runs
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(mark + CAST(joins AS INT) + chars + CASE WHEN ends THEN close ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

RANKED_SEARCH = r"""
WITH lowered AS (
    SELECT row_number() OVER () AS row_no, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
counts AS (
    SELECT row_no, doc_id, term, count(*) AS tf
    FROM (SELECT row_no, doc_id, unnest(regexp_extract_all(text, '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM lowered) GROUP BY row_no, doc_id, term
),
lengths AS (SELECT row_no, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY row_no),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark
),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, corpus WHERE term IN (SELECT term FROM wanted) GROUP BY term
),
parts AS (
    SELECT row_no, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) AS part
    FROM counts JOIN weights USING (term) JOIN lengths USING (row_no), corpus
),
scores AS (
    SELECT item_id, row_no, doc_id, CAST(sum(part) AS BIGINT) AS score FROM wanted JOIN parts USING (term) GROUP BY item_id, row_no, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 50
"""

SQL: dict[str, str] = {"op3_quality_rules": QUALITY_RULES, "op4_url_filters": URL_FILTERS, "op10_chat_formatting": CHAT_FORMATTING, "op12_ranked_search": RANKED_SEARCH}
