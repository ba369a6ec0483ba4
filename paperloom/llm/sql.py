"""SQL equivalents of the queries that SQL can express, written from the rules."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d),
places AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 4], ' ')) AS n FROM places),
again AS (SELECT r, count(DISTINCT i + k) AS n FROM windows, range(0, 5) x(k) WHERE windows.n > 1 GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS n_dup FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY r),
m AS (
  SELECT w.r, doc_id, t, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n_dup, 0) AS BIGINT) AS n_dup_lines, coalesce(dup.n, 0) AS n_lines,
    CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(t, '[^!]', '', 'g')) AS shouts,
    len(regexp_extract_all(t, '[A-Z][A-Z]')) AS pairs
  FROM w LEFT JOIN dup ON dup.r = w.r LEFT JOIN again ON again.r = w.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_symbols > 20 * n_words OR 100 * shouts > 20 * n_words
    OR 100 * pairs > 40 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 100 * letters < 60 * word_chars) AS kept
FROM b"""

LINE_TEMPLATES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
cut AS (SELECT r, text, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS nr
  FROM d WHERE text IS NOT NULL),
worded AS (SELECT r, nr, text, line, list_transform(regexp_extract_all(line, '{WORD}'),
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS ws FROM cut),
keyed AS (SELECT r, nr, text, line, ws, array_to_string(ws, ' ') AS k FROM worded),
found AS (SELECT DISTINCT text, k, len(ws) AS n FROM keyed WHERE len(ws) > 0),
counts AS (SELECT k, n, count(*) AS docs FROM found GROUP BY k, n),
shaped AS (SELECT DISTINCT c.k, c.docs, x.ws FROM counts c JOIN keyed x ON x.k = c.k WHERE len(x.ws) > 3),
places AS (SELECT k, docs, len(ws) AS n, array_to_string(ws[1:3], ' ') AS head, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p
  FROM shaped),
common AS (SELECT n, head, p, word, sum(docs) AS s FROM places GROUP BY n, head, p, word),
general AS (SELECT pl.k, pl.n, sum(CASE WHEN pl.p <= 3 OR s >= CASE WHEN pl.n > 50 THEN 2 ELSE 5 END THEN 1 ELSE 0 END) AS kept,
    string_agg(CASE WHEN pl.p <= 3 OR s >= CASE WHEN pl.n > 50 THEN 2 ELSE 5 END THEN pl.word ELSE chr(1) END, ' ' ORDER BY pl.p) AS shape
  FROM places pl JOIN common c ON c.n = pl.n AND c.head = pl.head AND c.p = pl.p AND c.word = pl.word GROUP BY pl.k, pl.n),
near AS (SELECT k, n, shape FROM general WHERE kept >= 0.6 * n),
recurring AS (SELECT shape FROM near JOIN found ON found.k = near.k GROUP BY shape
  HAVING count(DISTINCT text) >= CASE WHEN any_value(near.n) > 50 THEN 2 ELSE 5 END),
gone AS (SELECT k FROM counts WHERE docs >= CASE WHEN n > 50 THEN 2 ELSE 5 END UNION SELECT k FROM near JOIN recurring ON recurring.shape = near.shape),
marked AS (SELECT x.r, x.nr, x.line, len(x.ws) > 0 AS has_word, gone.k IS NOT NULL AND len(x.ws) > 0 AS dropped
  FROM keyed x LEFT JOIN gone ON gone.k = x.k),
per AS (SELECT r, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT dropped), '') AS text_kept FROM marked GROUP BY r)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, per.text_kept
FROM d LEFT JOIN per ON per.r = d.r"""

EXACT = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d"""
