"""DuckDB SQL for the operators that SQL can express, written from the definitions."""

from __future__ import annotations

import string

ORACLE: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, root) AS (
  SELECT a, a FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.id
),
component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
"""

ORACLE["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE len(ws) WHEN 0 THEN [] WHEN 1 THEN [ws[1]]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
  FROM split
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), {_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN component ON id = d.doc_id
"""

# The lenient and the strict form of each rule, in percent but for the last.
_RULES = [
    ("n_symbols", "n_words", 100, 40, 15),
    ("n_dup_lines", "n_lines", 100, 40, 20),
    ("n_repeat_words", "n_words", 100, 30, 20),
    ("n_upper", "word_chars", 100, 60, 40),
    ("n_exclaim", "n_words", 100, 50, 25),
    ("n_same_next", "n_words", 100, 40, 20),
    ("word_chars", "n_words", 1, 20, 15),
]
_LENIENT = " OR ".join(f"{a} * {per} > {b} * {soft}" for a, b, per, soft, _ in _RULES)
_STRICT = " OR ".join(f"{a} * {per} > {b} * {hard}" for a, b, per, _, hard in _RULES)
_BASE = "(n_words < 20 OR 100 * n_repeat_words > 30 * n_words)"

ORACLE["op2_quality_rules"] = rf"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM split)
), twice AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY doc_id
), measured AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaim,
         CASE WHEN len(ws) > 1 THEN len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) ELSE 0 END AS n_same_next
  FROM split LEFT JOIN repeated r USING (doc_id)
), judged AS (
  SELECT *, {_BASE} AS base_failed, ({_LENIENT}) AS lenient, ({_STRICT}) AS strict FROM measured
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (strict OR base_failed) AS failed FROM judged GROUP BY source
), prior AS (
  SELECT sum(failed) / sum(n) AS mean, avg((failed / n) * (failed / n)) - avg(failed / n) * avg(failed / n) AS spread, avg(1 / n) AS inverse
  FROM hosts
), strength AS (
  SELECT mean, greatest(mean * (1 - mean) / greatest(spread - mean * (1 - mean) * inverse, 1e-6) - 1, 1.0) AS s FROM prior
), rates AS (SELECT source, (failed + mean * s) / (n + s) AS host_rate FROM hosts, strength)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (CASE WHEN host_rate > 0.5 THEN strict ELSE lenient END) AS kept,
       round(host_rate, 6) AS host_rate, host_rate > 0.5 AS host_failed
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

ORACLE["op9_embedding_near_dedup"] = f"""
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), {_COMPONENTS}
SELECT e.vec_id, count(k.a) AS n_links, any_value(coalesce(component_id, e.vec_id)) AS component_id,
       e.vec_id = any_value(coalesce(component_id, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN component ON id = e.vec_id LEFT JOIN both_ways k ON k.a = e.vec_id GROUP BY e.vec_id
"""

# crc32 of the id's decimal digits, bit by bit; a run of the smallest period q has six equal words q apart wherever it is as long as it must be.
ORACLE["op11_periodic_runs"] = rf"""
WITH coded AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
      lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda x, y: xor(xor(x, y) >> 1, 3988292384::BIGINT * (xor(x, y) & 1))), 4294967295::BIGINT) AS h
  FROM documents
), places AS (
  SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM coded
), planted AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(0, n), lambda i: ws[1 + (CASE WHEN i < a THEN i
      ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END)]) END AS ws
  FROM places
), six AS (
  SELECT doc_id, i, array_to_string(ws[i + 1 : i + 6], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(0, n - 5)) AS i FROM planted WHERE n >= 12)
), pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e FROM islands GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, s AS start, e - s AS length, min(q) AS period FROM stretches WHERE e - s >= greatest(12, 2 * q) GROUP BY doc_id, s, e
), told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         first(start ORDER BY length DESC, start, period) AS start, first(length ORDER BY length DESC, start, period) AS length,
         first(period ORDER BY length DESC, start, period) AS period
  FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, n)) AS i FROM planted) w
  LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i WHERE g.i IS NULL GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op13_filter_audit"] = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), failing AS (
  SELECT d.doc_id, part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM texts d
), known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda l, k: fails[k]) AS failed, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM failing LEFT JOIN known USING (doc_id)
), grouped AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, failed
), orders(letters) AS (
  SELECT '' UNION ALL SELECT letters || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(l) WHERE NOT contains(letters, l)
), steps AS (
  SELECT letters AS filter_order, k AS step, string_split(letters[1 : k - 1], '') AS before, letters[k] AS letter
  FROM orders, range(1, 6) AS r(k) WHERE length(letters) = 5
), figures AS (
  SELECT part, filter_order, step, letter,
         sum(n) FILTER (NOT list_has_any(failed, before) AND NOT list_contains(failed, letter)) AS kept,
         sum(n) FILTER (NOT list_has_any(failed, before) AND list_contains(failed, letter)) AS removed,
         sum(n) FILTER (list_has_any(failed, before) AND list_contains(failed, letter)) AS redundant,
         sum(n) FILTER (failed = [letter]) AS unique_fails,
         sum(good) FILTER (NOT list_has_any(failed, before) AND list_contains(failed, letter)) AS good_lost,
         sum(toxic) FILTER (NOT list_has_any(failed, before) AND list_contains(failed, letter)) AS toxic_lost
  FROM grouped, steps GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM figures
"""
