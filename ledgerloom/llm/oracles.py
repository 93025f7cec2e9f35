"""DuckDB SQL of the numbered queries that SQL can express."""

from __future__ import annotations

#: Words of a text: digits, letters (A-Z as a-z) and everything beyond ASCII.
_NORMAL_WORDS = "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Words between spaces.
_SPACED_WORDS = "list_filter(regexp_split_to_array(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

#: The phrases of the line rule.
_BOILERPLATE = (
    "all rights reserved|licensed under|terms of service|terms of use|privacy policy|cookie policy|accept cookies|"
    "enable javascript|subscribe to|sign up|log in to|click here|share this|powered by"
)


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(line, '{pattern}'))"


ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
WITH item AS (
  SELECT item_id, {_NORMAL_WORDS.format('text')} AS w FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, {_NORMAL_WORDS.format('text')} AS w FROM documents
), size AS (
  SELECT DISTINCT len(string_split(win, ' ')) AS k FROM item_window
), doc_window AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, size WHERE len(w) >= k)
), hit AS (
  SELECT d.doc_id, d.i, d.k, m.item_id FROM doc_window d JOIN item_window m USING (win)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op7_quality_rules": f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS body, {_SPACED_WORDS.format('text')} AS w FROM documents
), line AS (
  SELECT doc_id, line, {_SPACED_WORDS.format('line')} AS lw
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM doc)
), judged AS (
  SELECT doc_id, line, len(lw) AS n, len(lw) > 0 AND (
    NOT regexp_matches(line, '[.!?…。！？]')
    OR 100 * {_count('[#*$%&|<>]')} > 10 * length(line)
    OR 100 * {_count('[|›»•]')} > 20 * len(lw)
    OR ({_count('!')} > 1 AND 100 * {_count('!')} > 25 * len(lw))
    OR 100 * len(list_filter(range(2, len(lw) + 1), lambda i: lw[i] = lw[i - 1])) > 30 * len(lw)
    OR regexp_matches(lower(line), '{_BOILERPLATE}')) AS failed
  FROM line
), lines AS (
  SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
         count(*) FILTER (failed) AS n_failed_lines, coalesce(sum(n) FILTER (NOT failed), 0) AS n_kept_words
  FROM judged GROUP BY doc_id
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM doc WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM win) WHERE c > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols,
         n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed,
         n_lines, n_failed_lines, n_kept_words
  FROM doc LEFT JOIN repeated USING (doc_id) JOIN lines USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_kept_words >= 50 * n_words AS kept, CAST(n_lines AS BIGINT) AS n_lines,
       CAST(n_failed_lines AS BIGINT) AS n_failed_lines, CAST(n_kept_words AS BIGINT) AS n_kept_words
FROM base
""",
    "op6_ngram_jaccard_join": f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, {_SPACED_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM doc WHERE len(w) > 0)
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), overlap AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM overlap JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id, doc_id AS r FROM doc UNION SELECT reach.doc_id, y FROM reach JOIN link ON x = r
), degree AS (
  SELECT x AS doc_id, count(*) AS n_links FROM link GROUP BY x
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, CAST(coalesce(any_value(n_links), 0) AS BIGINT) AS n_links, min(r) AS component_id
FROM reach LEFT JOIN size USING (doc_id) LEFT JOIN degree USING (doc_id) GROUP BY doc_id
""",
}
