"""SQL counterparts of the corpus queries, for DuckDB over the same tables.

The other corpus queries have none: suffixes, token ids, connected components and contexts are held
against brute-force versions in the tests.
"""

from __future__ import annotations

from caseline.llm.queries import MIX_WEIGHTS

ORACLES: dict[str, str] = {}

ORACLES["op2_quality_rules"] = r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)
), rep AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1
), cov AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id
), m AS (
    SELECT w.doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
           len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_kinds,
           coalesce(cov.n, 0) AS n_repeat_words,
           length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS upper,
           length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS letters,
           coalesce(list_max(map_values(list_histogram(w))), 0) AS top,
           len(string_split(t, chr(10))) AS lines
    FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id
), f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_lines - n_kinds AS n_dup_lines FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > word_chars OR (2 * n_dup_lines > lines AND lines >= 4)
            OR (n_words >= 20 AND 2 * top > n_words)
            OR (10 * upper > 7 * letters AND letters > 40)) AS kept
FROM f
"""

_WEIGHT = " ".join(f"WHEN source = '{name}' THEN {value}" for name, value in MIX_WEIGHTS.items())

ORACLES["op4_source_mixing"] = f"""
WITH n AS (SELECT source, count(*) AS n, CASE {_WEIGHT} ELSE 1.0 END AS w FROM documents GROUP BY source),
r AS (SELECT source, w * (SELECT sum(n) FROM n) / (SELECT sum(w) FROM n) / n AS rate FROM n),
p AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM r, range(0, 200) AS g(k)),
c AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p),
d AS (SELECT doc_id, source, md5(text) AS text_md5,
             ('0x' || substr(md5('17:' || doc_id), 1, 12))::UBIGINT / 281474976710656.0::DOUBLE AS u FROM documents),
t AS (SELECT d.doc_id, d.source, d.text_md5, count(*) AS times FROM d JOIN c ON c.source = d.source AND c.c <= d.u GROUP BY ALL)
SELECT doc_id, source, text_md5, unnest(range(0, times)) AS replica FROM t
"""

_CANONICAL = r"""
    SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM pages
"""

ORACLES["op7_revisit_resolution"] = rf"""
WITH b AS ({_CANONICAL}),
q AS (
    SELECT page_id, html, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '') AS host,
           regexp_replace(regexp_replace(regexp_replace(b, '^[^/?]*', ''), '\?.*$', ''), '/+$', '') AS path,
           list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
               lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS args
    FROM b
),
u AS (SELECT page_id, html, md5(html) AS digest,
             host || path || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS canonical FROM q),
full_ AS (SELECT canonical, page_id * 60 AS at, 3 * page_id AS response_id, digest, strlen(html)::VARCHAR AS size FROM u),
again AS (
    SELECT canonical, page_id * 60 + 3600 AS at, 3 * page_id + 1 AS record_id, 'W/"' || digest || '"' AS etag,
           '0' AS size, page_id::VARCHAR || '+1' AS date FROM u
    UNION ALL
    SELECT canonical, page_id * 60 + 86400, 3 * page_id + 2,
           CASE WHEN length(html) % 2 = 0 THEN '"new"' ELSE '"' || digest || '"' END, NULL, page_id::VARCHAR || '+2' FROM u
),
j AS (SELECT a.*, f.response_id AS rid, f.digest AS body, f.size AS body_size,
             CASE WHEN f.response_id IS NULL THEN 'missing'
                  WHEN regexp_replace(a.etag, '^W/', '') = '"' || f.digest || '"' THEN 'resolved' ELSE 'changed' END AS outcome
      FROM again a ASOF LEFT JOIN full_ f ON a.canonical = f.canonical AND a.at > f.at)
SELECT record_id, canonical, outcome, CASE WHEN outcome = 'resolved' THEN rid END AS response_id,
       CASE WHEN outcome = 'resolved' THEN body END AS digest, etag,
       CASE WHEN outcome = 'resolved' THEN body_size ELSE size END AS content_length, date
FROM j
"""

_GRAMS = r"""
    SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i FROM (
        SELECT {id}, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}) WHERE len(w) >= 5
"""

ORACLES["op8_decontamination"] = f"""
WITH d AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM ({_GRAMS.format(id="doc_id", table="documents")})),
b AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS g FROM ({_GRAMS.format(id="item_id", table="benchmark")})),
n AS (SELECT item_id, count(*) AS n_grams FROM b GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_grams, n_shared / n_grams AS containment
FROM s JOIN n USING (item_id) WHERE n_shared >= n_grams * 0.8 - 1e-9
"""
