"""DuckDB SQL for the registered queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '{_SPACE}+'), lambda x: x <> '')"


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


# Summaries

ORACLE["daily_summary"] = """
SELECT o_orderpriority AS airline_code, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS scheduled_date,
       count(*) AS total_flights,
       CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS delayed_count,
       CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS cancelled_count,
       round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS avg_delay_minutes,
       round(100.0 * count(*) FILTER (o_orderstatus NOT IN ('F', 'P')) / count(*), 1) AS on_time_pct
FROM orders GROUP BY 1, 2
"""

ORACLE["delay_by_cause"] = """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderpriority AS cause, count(*) AS delayed_count,
       round(avg(o_totalprice), 4) AS avg_delay_minutes
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
"""

# State tables

ORACLE["latest_per_key"] = """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLE["latest_merge"] = """
WITH target AS (
  SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
), source AS (
  SELECT event_id, ts, user_id, upper(event_type) AS event_type, value, props
  FROM events WHERE ts >= TIMESTAMP '2024-01-10'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT s.* FROM source s LEFT JOIN target t USING (user_id) WHERE t.user_id IS NULL OR s.ts > t.ts
UNION ALL
SELECT t.* FROM target t LEFT JOIN source s USING (user_id) WHERE s.user_id IS NULL OR NOT s.ts > t.ts
"""

ORACLE["state_as_of"] = """
SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

_AUDIT = f"""
WITH history AS (
  SELECT user_id, CAST(ts AS DATE) AS batch, ts - to_hours({_K}) AS event_ts FROM events
), per_batch AS (
  SELECT user_id, batch, max(event_ts) AS newest FROM history GROUP BY 1, 2
), seen AS (
  SELECT *, (SELECT max(event_ts) FROM history h WHERE h.user_id = p.user_id AND h.batch < p.batch) AS known
  FROM per_batch p
), counts AS (
  SELECT batch, count(*) FILTER (known IS NULL) AS inserted, count(*) FILTER (newest > known) AS updated,
         count(*) FILTER (newest <= known) AS stale
  FROM seen GROUP BY 1
), audit AS (
  SELECT row_number() OVER (ORDER BY batch) - 1 AS version, batch,
         CASE WHEN row_number() OVER (ORDER BY batch) = 1 THEN 'WRITE' ELSE 'MERGE' END AS operation,
         inserted, updated, stale, CAST(sum(inserted) OVER (ORDER BY batch) AS BIGINT) AS state_rows
  FROM counts
)
"""
ORACLE["merge_audit"] = f"{_AUDIT} SELECT * REPLACE (CAST(batch AS VARCHAR) AS batch) FROM audit"
ORACLE["version_range"] = f"{_AUDIT} SELECT min(version) AS earliest_version, max(version) AS latest_version FROM audit"

ORACLE["expired_versions"] = """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, ts FROM (
  SELECT event_id, nullif(user_id, 7) AS user_id, ts,
         lead(ts) OVER (PARTITION BY nullif(user_id, 7) ORDER BY ts, event_id) AS replaced_at
  FROM events
) WHERE replaced_at < TIMESTAMP '2024-01-20'
"""

ORACLE["purge_bad_keys"] = """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 5000)
"""

ORACLE["purge_bad_rows"] = """
SELECT o_orderkey, o_custkey AS c_custkey, o_totalprice FROM orders WHERE NOT o_totalprice < 5000
"""

ORACLE["schema_evolve_union"] = """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
"""


# Quality


def _check(name: str, dimension: str, success: str, bad: str, rows: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{dimension}' AS dimension, {success} AS success, "
        f"CAST({bad} AS BIGINT) AS unexpected_count, CAST({rows} AS BIGINT) AS row_count FROM {source}"
    )


def _count_check(name: str, dimension: str, where: str, source: str) -> str:
    bad = f"count(*) FILTER ({where})"
    return _check(name, dimension, f"{bad} = 0", bad, "count(*)", source)


ORACLE["gate_bronze"] = "\nUNION ALL\n".join(
    [
        _count_check("not_null(user_id)", "completeness", "user_id IS NULL", "events"),
        _count_check("in_set(event_type)", "validity", "event_type NOT IN ('click','view','purchase','signup')", "events"),
        _check("between(value)", "accuracy",
               "count(*) FILTER (value BETWEEN 0.5 AND 200) >= 0.9 * count(value)",
               "count(*) FILTER (value < 0.5 OR value > 200)", "count(*)", "events"),
        _count_check("pair_differs(event_id,user_id)", "consistency", "event_id = user_id", "events"),
    ]
)

ORACLE["gate_silver"] = "\nUNION ALL\n".join(
    [
        _count_check("unique(l_orderkey)", "uniqueness", "n > 1",
                     "(SELECT count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"),
        _count_check("regex(l_returnflag)", "validity", "l_returnflag NOT IN ('A', 'N')", "lineitem"),
        _count_check("regex(l_linestatus)", "validity", "NOT regexp_matches(l_linestatus, '^[A-Z]$')", "lineitem"),
        _count_check("max_drift(l_shipdate,promised)", "timeliness", "abs(l_linenumber - 3) > 1", "lineitem"),
    ]
)

_SCAN = "\nUNION ALL\n".join(
    [
        _check("null_ratio(marked)", "completeness", "avg(CASE WHEN lang = 'de' THEN 1.0 ELSE 0.0 END) < 0.05",
               "count(*) FILTER (lang = 'de')", "count(*)", "documents"),
        _count_check("between(n_chars)", "accuracy", "n_chars NOT BETWEEN 20 AND 10000", "documents"),
        _count_check("pair_differs(lang,source)", "consistency", "lang = source", "documents"),
        _count_check("equals(marked)", "timeliness", "lang <> 'en'", "documents"),
        _check("no_duplicate_rows", "uniqueness", "count(*) = count(DISTINCT text)",
               "count(*) - count(DISTINCT text)", "count(*)", "documents"),
        _count_check("regex(marked)", "validity", "lang = 'de' OR NOT regexp_matches(lang, '^[a-z]{2}$')", "documents"),
    ]
)
ORACLE["dq_scan"] = _SCAN
ORACLE["dq_verdict"] = f"""
SELECT bool_and(success) AS passed, count(*) FILTER (success) AS checks_passed, count(*) AS checks,
       max(row_count) AS row_count FROM ({_SCAN})
"""

ORACLE["profile_table"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"round(100.0 * (count(*) - count({c})) / count(*), 1) AS null_pct, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
    for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
)

ORACLE["value_counts"] = 'SELECT event_type AS value, count(*) AS "rows" FROM events GROUP BY 1'

# Ingest contract

_STATUS = """CASE WHEN k = 30 THEN 'ON_APPROACH' WHEN event_type = 'click' THEN 'BOARDING'
  WHEN event_type = 'signup' THEN 'GATE_CHANGE' WHEN event_type = 'error' THEN 'DELAYED'
  WHEN event_type = 'purchase' THEN 'DEPARTED' ELSE 'SCHEDULED' END"""
_REASONS = f"""
WITH raw AS (
  SELECT event_id, user_id, ts, value, k, {_STATUS} AS status
  FROM (SELECT *, {_K} AS k FROM events)
), judged AS (
  SELECT *, CASE
    WHEN k IN (90, 91, 92, 93, 94, 99) THEN '|json_invalid|Invalid JSON'
    WHEN k = 98 THEN '|model_type|Input should be a valid object'
    WHEN k = 60 THEN 'origin|string_too_short|String should have at least 3 characters;' ||
      'status|enum|Input should be ''SCHEDULED'', ''BOARDING'', ''GATE_CHANGE'', ''DEPARTED'', ''DELAYED'', ''ARRIVED'' or ''CANCELLED'''
    WHEN k = 61 THEN 'airline_code|string_too_short|String should have at least 2 characters;' ||
      'delay_minutes|greater_than_equal|Input should be greater than or equal to 0;' ||
      'event_ts|datetime_from_date_parsing|Input should be a valid datetime or date'
    WHEN k = 80 THEN 'flight_id|missing|Field required'
    WHEN k = 10 THEN 'airline_code|string_too_short|String should have at least 2 characters'
    WHEN k = 11 THEN 'airline_code|string_too_long|String should have at most 3 characters'
    WHEN k = 12 THEN 'airline_code|string_type|Input should be a valid string'
    WHEN k = 20 THEN 'scheduled_date|date_from_datetime_parsing|Input should be a valid date or datetime'
    WHEN k = 21 THEN 'scheduled_date|date_type|Input should be a valid date'
    WHEN k = 22 THEN 'origin|string_too_short|String should have at least 3 characters'
    WHEN k = 30 THEN 'status|enum|Input should be ''SCHEDULED'', ''BOARDING'', ''GATE_CHANGE'', ''DEPARTED'', ''DELAYED'', ''ARRIVED'' or ''CANCELLED'''
    WHEN k = 50 THEN 'delay_minutes|greater_than_equal|Input should be greater than or equal to 0'
    WHEN k = 51 THEN 'delay_minutes|int_from_float|Input should be a valid integer, got a number with a fractional part'
    WHEN k = 54 THEN 'delay_minutes|int_parsing|Input should be a valid integer, unable to parse string as an integer'
    WHEN k = 70 THEN 'event_ts|datetime_from_date_parsing|Input should be a valid datetime or date'
    WHEN status IN ('BOARDING', 'GATE_CHANGE') AND k < 15
      THEN '|value_error|Value error, gate is required when status is ' || status
    WHEN status = 'DELAYED' AND k < 25
      THEN '|value_error|Value error, delay_reason_code is required when status is DELAYED'
  END AS reasons FROM raw
)
"""
ORACLE["contract_accept"] = f"""{_REASONS}
SELECT event_id, 'SV' || user_id AS flight_id, 'SV' AS airline_code, CAST(user_id AS VARCHAR) AS flight_number,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS scheduled_date, 'RUH' AS origin, 'JED' AS destination, status,
       CASE WHEN k >= 15 THEN 'A12' END AS gate,
       CAST(CASE WHEN k = 52 THEN 30 WHEN k = 53 THEN 1 WHEN k = 55 THEN NULL ELSE floor(value) END AS INTEGER)::VARCHAR AS delay_minutes,
       CASE WHEN k >= 25 THEN 'ATC' END AS delay_reason_code, 'ops' AS source_feed,
       CASE WHEN k = 71 THEN epoch_us(date_trunc('second', ts)) ELSE epoch_us(ts) END AS event_us
FROM judged WHERE reasons IS NULL
"""
ORACLE["contract_dlq"] = f"""{_REASONS}
SELECT event_id, CAST(len(string_split(reasons, ';')) AS INTEGER) AS problems, reasons FROM judged WHERE reasons IS NOT NULL
"""
ORACLE["contract_counts"] = f"""{_REASONS}
SELECT count(*) AS consumed, count(*) FILTER (reasons IS NULL) AS accepted, count(reasons) AS rejected FROM judged
"""

# Run events

ORACLE["run_latest_state"] = """
WITH run_events AS (
  SELECT event_id, user_id AS run_id, ts,
         CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'COMPLETE' WHEN 'error' THEN 'FAIL' ELSE 'OTHER' END AS state
  FROM events
), folded AS (
  SELECT run_id, min(ts) FILTER (state = 'START') AS started_at,
         max(ts) FILTER (state IN ('COMPLETE', 'FAIL')) AS ended_at, count(*) AS events
  FROM run_events GROUP BY 1
), last AS (
  SELECT run_id, state AS last_state FROM run_events
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) = 1
)
SELECT run_id, last_state, started_at, ended_at, events,
       (epoch_us(ended_at) - epoch_us(started_at))::DOUBLE / 1000000 AS duration_s
FROM folded JOIN last USING (run_id)
"""

# Event-time windows

_FLAGGED = f"""
WITH arrivals AS (
  SELECT event_id, event_type, value, {_K} AS k, ts - to_minutes({_K}) AS event_ts FROM events
), marked AS (
  SELECT *, greatest(TIMESTAMP '2024-01-01', coalesce(max(event_ts) OVER (
           ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TIMESTAMP '2024-01-01')) AS watermark
  FROM arrivals
), flagged AS (
  SELECT *, event_ts < watermark - INTERVAL 30 MINUTE AS late FROM marked
)
"""
ORACLE["late_events"] = f"{_FLAGGED} SELECT event_id, event_ts, watermark, late FROM flagged"
ORACLE["late_counts"] = f"{_FLAGGED} SELECT count(*) AS arrived, count(*) FILTER (late) AS dropped FROM flagged"
ORACLE["tumbling_count"] = "SELECT date_trunc('hour', ts) AS window_start, count(*) AS events FROM events GROUP BY 1"
ORACLE["hopping_mean"] = """
SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2024-01-01') - to_minutes(15 * CAST(hop AS INTEGER)) AS window_start,
       round(avg(value), 6) AS mean_value, count(*) AS events
FROM events, range(4) AS hops(hop) GROUP BY 1, 2
"""
ORACLE["sliding_mean"] = f"""{_FLAGGED}, delayed AS (
  SELECT event_id, nullif(event_type, 'signup') AS event_type, event_ts,
         value * CASE event_type WHEN 'click' THEN 1e-7 WHEN 'view' THEN 1e11 ELSE 1 END AS value,
         CASE event_type WHEN 'click' THEN 1e-7 WHEN 'view' THEN 1e11 ELSE 1 END AS unit
  FROM flagged WHERE NOT late AND k >= 20
), reached AS (SELECT *, max(event_ts) OVER (PARTITION BY event_type ORDER BY event_id) AS high FROM delayed)
SELECT i.event_id, i.event_type, round(avg(j.value) / any_value(i.unit), 6) AS rolling_mean, count(*) AS rolling_count
FROM reached i JOIN reached j
  ON j.event_type IS NOT DISTINCT FROM i.event_type AND j.event_id <= i.event_id AND j.event_ts > i.high - INTERVAL 60 MINUTE
GROUP BY 1, 2
"""
ORACLE["severe_events"] = f"{_FLAGGED} SELECT event_id, event_type, value, event_ts FROM flagged WHERE value > 120 AND NOT late"

# Retrieval

_CHUNKS = f"""
pieces AS (
  SELECT doc_id, lang || ' document ' || doc_id AS doc_title, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents
), sections AS (
  SELECT doc_id || '::' || n AS chunk_id, doc_title, {_strip("'## ' || line")} AS text FROM pieces
), chunks AS (
  SELECT chunk_id, doc_title,
         CASE WHEN length(text) > 3 THEN {_strip("regexp_extract(substr(text, 4), '^[^\\n\\r\\x0B\\f\\x1C-\\x1E\\x{85}\\x{2028}\\x{2029}]*')")}
              ELSE 'Overview' END AS section_title, text
  FROM sections
)
"""
# By document as text, then by the number of the section.
_CHUNK_ORDER = "split_part(chunk_id, '::', 1), CAST(split_part(chunk_id, '::', 2) AS INTEGER)"
ORACLE["chunk_sections"] = f"WITH {_CHUNKS} SELECT * FROM chunks"


def _bm25(source: str, item: str, k: int, order: str | None = None) -> str:
    """CTEs ending in `sparse(query_id, item, score, rank)` over `source(item, text)` for the benchmark texts."""
    return f"""
questions AS (SELECT item_id AS query_id, text AS query FROM benchmark),
lengths AS (SELECT {item}, {_words("text")} AS words FROM {source}),
occurrences AS (SELECT {item}, len(words) AS length, unnest(words) AS term FROM lengths),
tfs AS (SELECT {item}, length, term, count(*) AS tf FROM occurrences GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY 1),
corpus AS (SELECT count(*) AS n, sum(len(words)) / count(*) AS mean_length FROM lengths),
idfs AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM dfs, corpus),
weights AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM idfs) ELSE idf END AS idf FROM idfs),
asked AS (SELECT query_id, unnest({_words("query")}) AS term FROM questions),
gains AS (
  SELECT query_id, {item}, sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean_length))) AS gain
  FROM asked JOIN weights USING (term) JOIN tfs USING (term), corpus GROUP BY 1, 2
),
scores AS (
  SELECT q.query_id, s.{item}, round(coalesce(gain, 0), 9) AS score
  FROM questions q CROSS JOIN lengths s LEFT JOIN gains g ON g.query_id = q.query_id AND g.{item} = s.{item}
),
sparse AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {order or item}) - 1 AS rank FROM scores
  QUALIFY rank < {k}
)"""


_RANKED = 'CAST(rank AS INTEGER) AS "rank"'
ORACLE["bm25_terms"] = f"""
WITH words AS (SELECT doc_id, unnest({_words("text")}) AS term FROM documents)
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS occurrences FROM words GROUP BY 1
"""
ORACLE["bm25_topk"] = f"""
WITH {_bm25("documents", "doc_id", 10)}
SELECT query_id, doc_id, round(score, 6) AS score, {_RANKED} FROM sparse
"""
ORACLE["bm25_blocks"] = ORACLE["bm25_topk"]
ORACLE["bm25_postings_read"] = f"""
WITH {_bm25("documents", "doc_id", 10)}
SELECT CAST(sum(df) AS BIGINT) AS matching, true AS fewer_read FROM (SELECT DISTINCT query_id, term FROM asked) JOIN dfs USING (term)
"""
ORACLE["bm25_three_loads"] = f"""
WITH kept AS (SELECT doc_id, text FROM documents WHERE doc_id % 10 <> 7), {_bm25("kept", "doc_id", 10)}
SELECT query_id, doc_id, round(score, 6) AS score, {_RANKED} FROM sparse
"""

_CENTROIDS = """
flat AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
centroids AS (SELECT label AS query_id, i, avg(x) AS x FROM flat GROUP BY 1, 2)
"""
ORACLE["knn_exact"] = f"""
WITH {_CENTROIDS}, distances AS (
  SELECT query_id, vec_id, round(-sum((c.x - f.x) * (c.x - f.x)), 9) AS score
  FROM centroids c JOIN flat f USING (i) GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) - 1 AS rank FROM distances QUALIFY rank < 10
)
SELECT query_id, vec_id, round(score, 6) AS score, {_RANKED} FROM ranked
"""

ORACLE["knn_approx_probed"] = f"""
WITH flat AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
planes AS (
  SELECT t, b, i, CASE WHEN substr(md5(t || ':' || b || ':' || (i - 1)), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS s
  FROM range(12) AS x(t), range(6) AS y(b), (SELECT DISTINCT i FROM flat) AS z
), places AS (SELECT vec_id, t, b, round(sum(s * x), 9) AS place FROM flat JOIN planes USING (i) GROUP BY 1, 2, 3
), item_keys AS (SELECT vec_id, t, sum(CASE WHEN place > 0 THEN 1 << b ELSE 0 END) AS bucket FROM places GROUP BY 1, 2
), costs AS (
  SELECT vec_id, t, mask, round(sum(CASE WHEN (mask >> b) & 1 = 1 THEN place * place ELSE 0 END), 9) AS far
  FROM places, range(64) AS m(mask) WHERE vec_id % 100 = 0 GROUP BY 1, 2, 3
), visits AS (
  SELECT vec_id AS query_id, t, xor(bucket::BIGINT, mask) AS bucket
  FROM (SELECT * FROM costs QUALIFY row_number() OVER (PARTITION BY vec_id, t ORDER BY mask > 0, far, mask) <= 5) JOIN item_keys USING (vec_id, t)
), pairs AS (SELECT DISTINCT query_id, vec_id FROM visits JOIN item_keys USING (t, bucket)
), distances AS (
  SELECT query_id, p.vec_id, round(-sum((q.x - f.x) * (q.x - f.x)), 9) + 0.0 AS score
  FROM pairs p JOIN flat q ON q.vec_id = query_id JOIN flat f ON f.vec_id = p.vec_id AND f.i = q.i GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) - 1 AS rank FROM distances QUALIFY rank < 10
)
SELECT query_id, vec_id, round(score, 6) AS score, {_RANKED} FROM ranked
"""
ORACLE["knn_exact_all"] = f"""
WITH flat AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
distances AS (
  SELECT q.vec_id AS query_id, f.vec_id, round(-sum((q.x - f.x) * (q.x - f.x)), 9) + 0.0 AS score
  FROM flat q JOIN flat f USING (i) WHERE q.vec_id % 100 = 0 GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) - 1 AS rank FROM distances QUALIFY rank < 10
)
SELECT query_id, vec_id, round(score, 6) AS score, {_RANKED} FROM ranked
"""
ORACLE["knn_index_recall"] = """
SELECT count(*) FILTER (vec_id % 100 = 0) AS queries, true AS recall_reached, true AS few_in_full,
       count(*) FILTER (vec_id % 100 = 0) * count(*) AS pairs
FROM embeddings
"""


def _hashed(source: str, item: str, text: str) -> str:
    return f"""(
  SELECT {item}, slot, (n / sqrt(sum(n * n) OVER (PARTITION BY {item})))::FLOAT AS weight FROM (
    SELECT {item}, slot, count(*)::DOUBLE AS n FROM (
      SELECT {item}, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 256 AS slot
      FROM (SELECT {item}, unnest({_words(text)}) AS word FROM {source})
    ) GROUP BY 1, 2
  ))"""


ORACLE["embed_hashing"] = f"""
SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(weight::DOUBLE, 6) AS weight FROM {_hashed("documents", "doc_id", "text")}
"""
ORACLE["rrf_fusion"] = f"""
WITH {_bm25("documents", "doc_id", 10)},
hashed_queries AS (SELECT * FROM {_hashed("questions", "query_id", "query")}),
hashed_docs AS (SELECT * FROM {_hashed("documents", "doc_id", "text")}),
near AS (
  SELECT query_id, doc_id, round(sum(q.weight::DOUBLE * d.weight::DOUBLE), 9) AS score
  FROM hashed_queries q JOIN hashed_docs d USING (slot) GROUP BY 1, 2
),
dense AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) - 1 AS rank FROM near QUALIFY rank < 10
),
fused AS (
  SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(d.doc_id, s.doc_id) AS doc_id,
         coalesce(1.0::DOUBLE / (61 + d.rank), 0) + coalesce(1.0::DOUBLE / (61 + s.rank), 0) AS fused_score,
         d.rank AS dense_rank, s.rank AS sparse_rank
  FROM dense d FULL JOIN sparse s ON d.query_id = s.query_id AND d.doc_id = s.doc_id
)
SELECT query_id, doc_id, round(fused_score, 9) AS fused_score, CAST(row_number() OVER (
         PARTITION BY query_id ORDER BY fused_score DESC, dense_rank NULLS LAST, sparse_rank) - 1 AS INTEGER) AS "rank"
FROM fused
"""


def _reranked(source: str, item: str) -> str:
    wanted = f"list_distinct({_words('query')})"
    return f"""
shared AS (
  SELECT c.query_id, c.{item}, c.rank AS candidate_rank, d.* EXCLUDE ({item}),
         coalesce(len(list_intersect({wanted}, {_words("d.text")}))::DOUBLE / nullif(len({wanted}), 0), 0) AS rerank_score
  FROM sparse c JOIN {source} d ON d.{item} = c.{item} JOIN questions q ON q.query_id = c.query_id
),
reranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, candidate_rank) - 1 AS rank
  FROM shared QUALIFY rank < 3
)"""


ORACLE["rerank_topn"] = f"""
WITH {_bm25("documents", "doc_id", 8)}, {_reranked("documents", "doc_id")}
SELECT query_id, doc_id, {_RANKED}, CAST(candidate_rank AS INTEGER) AS candidate_rank, round(rerank_score, 6) AS rerank_score
FROM reranked
"""
ORACLE["rag_context"] = f"""
WITH {_CHUNKS}, {_bm25("chunks", "chunk_id", 8, _CHUNK_ORDER)}, {_reranked("chunks", "chunk_id")},
contexts AS (
  SELECT query_id, string_agg('[' || (rank + 1) || '] ' || text, chr(10) || chr(10) ORDER BY rank) AS context,
         string_agg(doc_title || ' > ' || section_title || '|' || substr(text, 1, 200)
                    || CASE WHEN length(text) > 200 THEN '...' ELSE '' END, ';' ORDER BY rank) AS citations
  FROM reranked GROUP BY 1
)
SELECT query_id, context,
       'Answer the question in one or two sentences, using only the excerpts below.' || chr(10) || chr(10) || 'Excerpts:' || chr(10)
       || context || chr(10) || chr(10) || 'Question: ' || query || chr(10) || 'Answer:' AS prompt, citations
FROM contexts JOIN questions USING (query_id)
"""

_SIMILAR = f"""
WITH {_CENTROIDS}, near AS (
  SELECT query_id, vec_id, round(sum(c.x * f.x) / (sqrt(sum(c.x * c.x)) * sqrt(sum(f.x * f.x))), 9) AS similarity
  FROM centroids c JOIN flat f USING (i) GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) - 1 AS rank FROM near QUALIFY rank < 10
), report AS (
  SELECT query_id, round(avg(CASE WHEN similarity > 0.3 THEN 1.0::DOUBLE ELSE 0 END), 3) AS context_precision,
         round(avg(similarity), 3) AS avg_similarity, count(*) AS chunks_in_context,
         string_agg(format('{{:.3f}}', round(similarity, 3)), ',' ORDER BY rank) AS per_chunk_scores
  FROM ranked GROUP BY 1
)
"""
ORACLE["retrieval_eval"] = f"{_SIMILAR} SELECT *, context_precision < 0.5 AS low_precision FROM report"
ORACLE["retrieval_overall"] = f"""{_SIMILAR}
SELECT round(avg(context_precision), 3) AS avg_context_precision, round(avg(avg_similarity), 3) AS avg_similarity,
       count(*) AS queries FROM report
"""
ORACLE["lookup_extracted_key"] = """
SELECT o_orderkey AS query_id, c_name, c_acctbal, c_mktsegment
FROM orders LEFT JOIN customer ON o_orderpriority <> '5-LOW' AND c_custkey = o_custkey
"""

# Tables, gates and streams

ORACLE["summary_head"] = f"{ORACLE['daily_summary'].strip()} ORDER BY scheduled_date, airline_code LIMIT 20"
ORACLE["seed_rows"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 5"
ORACLE["append_refused"] = """
SELECT load, (SELECT count(*) FROM events) AS row_count, problems FROM (VALUES
  ('fits', ''), ('changed', 'column ''user_id'' is string, the table has bigint'),
  ('missing', 'required column ''event_id'' is missing'), ('new', 'column ''extra'' is not in the table')) AS t(load, problems)
"""
ORACLE["clustered_files"] = """
SELECT count(*) AS row_count, min(o_custkey) AS min_key, max(o_custkey) AS max_key, true AS disjoint FROM orders
"""
ORACLE["gate_outcome"] = f"""
SELECT bool_and(success) AS passed, count(*) FILTER (success) AS checks_passed, count(*) AS checks, max(row_count) AS row_count, 'bronze' AS gate
FROM ({ORACLE["gate_bronze"]})
UNION ALL
SELECT bool_and(success), count(*) FILTER (success), count(*), max(row_count), 'silver' FROM ({ORACLE["gate_silver"]})
"""
ORACLE["routed_batch"] = """
SELECT batch, CASE WHEN (SELECT min(o_totalprice) FROM orders) >= low THEN 'production' ELSE 'quarantine' END AS place,
       (SELECT count(*) FROM orders) AS row_count
FROM (VALUES ('low', 0), ('high', 5000)) AS t(batch, low)
"""
ORACLE["duplicate_events"] = f"""
SELECT 'no_duplicate_rows' AS "check", 'uniqueness' AS dimension, count(*) FILTER ({_K} >= 50) = 0 AS success,
       count(*) FILTER ({_K} >= 50) AS unexpected_count, 2 * count(*) AS row_count
FROM events
"""
ORACLE["encode_events"] = """
SELECT '{"event_id":' || event_id || ',"event_type":' || CASE WHEN event_type = 'view' THEN 'null' ELSE '"' || event_type || '"' END
       || ',"ts":"' || strftime(ts + INTERVAL 123 MICROSECOND, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value
FROM events
"""
ORACLE["stream_tumbling"] = """
SELECT date_trunc('hour', ts) AS window_start, count(*) AS events FROM events GROUP BY 1
HAVING date_trunc('hour', any_value(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE
"""
ORACLE["stream_anomalies"] = "SELECT event_id, event_type, value FROM events WHERE value > 120"
ORACLE["stream_tail"] = "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'"
ORACLE["csv_scan"] = "SELECT count(*) AS row_count, round(sum(o_totalprice), 2) AS total, least(count(*), 100) AS first_rows FROM orders"
ORACLE["text_files"] = "SELECT rtrim(text, chr(10)) AS text FROM benchmark"
ORACLE["counted_write"] = "SELECT count(*) AS written, count(*) AS stored FROM orders WHERE o_orderstatus <> 'P'"
ORACLE["ingest_stamp"] = f"SELECT count(*) AS row_count, 1::BIGINT AS stamps FROM ({ORACLE['contract_accept']})"
ORACLE["stream_sliding_mean"] = """
WITH rows AS (SELECT event_id, nullif(event_type, 'signup') AS kind, ts, value FROM events)
SELECT i.event_id, i.kind, round(avg(j.value), 6) AS rolling_mean, count(*) AS rolling_count
FROM rows i JOIN rows j ON j.kind IS NOT DISTINCT FROM i.kind AND j.ts > i.ts - INTERVAL 60 MINUTE
  AND (j.ts < i.ts OR (j.ts = i.ts AND j.event_id <= i.event_id))
GROUP BY 1, 2
"""
ORACLE["stream_late_drops"] = ORACLE["late_counts"]

_ASKED = "SELECT item_id AS query_id, text || ' and SV' || lpad(CAST(item_id % 10000 AS VARCHAR), 4, '0') || '-' || (item_id // 10000 + 20240101) AS query FROM benchmark"
_SPARSE_CHUNKS = _bm25("chunks", "chunk_id", 8, _CHUNK_ORDER).replace("SELECT item_id AS query_id, text AS query FROM benchmark", _ASKED)
_CLOSENESS = "round(2 * coalesce(d, 0) - c.n - q.n, 9)"
ORACLE["ask_questions_all"] = f"""
WITH {_CHUNKS}, {_SPARSE_CHUNKS},
hashed_queries AS (SELECT * FROM {_hashed("questions", "query_id", "query")}),
hashed_chunks AS (SELECT * FROM {_hashed("chunks", "chunk_id", "text")}),
query_norms AS (SELECT query_id, sum(weight::DOUBLE * weight::DOUBLE) AS n FROM hashed_queries GROUP BY 1),
chunk_norms AS (SELECT chunk_id, sum(weight::DOUBLE * weight::DOUBLE) AS n FROM hashed_chunks GROUP BY 1),
dots AS (
  SELECT query_id, chunk_id, sum(q.weight::DOUBLE * c.weight::DOUBLE) AS d
  FROM hashed_queries q JOIN hashed_chunks c USING (slot) GROUP BY 1, 2
),
dense AS (
  SELECT q.query_id, c.chunk_id,
         row_number() OVER (PARTITION BY q.query_id ORDER BY {_CLOSENESS} DESC, {_CHUNK_ORDER.replace("chunk_id", "c.chunk_id")}) - 1 AS rank
  FROM query_norms q CROSS JOIN chunk_norms c LEFT JOIN dots ON dots.query_id = q.query_id AND dots.chunk_id = c.chunk_id
  QUALIFY rank < 8
),
fused AS (
  SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(d.chunk_id, s.chunk_id) AS chunk_id,
         coalesce(1.0::DOUBLE / (61 + d.rank), 0) + coalesce(1.0::DOUBLE / (61 + s.rank), 0) AS score, d.rank AS dr, s.rank AS sr
  FROM dense d FULL JOIN sparse s ON d.query_id = s.query_id AND d.chunk_id = s.chunk_id
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, dr NULLS LAST, sr) - 1 AS rank FROM fused
),
{_reranked("chunks", "chunk_id").replace("FROM sparse c", "FROM ordered c")},
contexts AS (
  SELECT query_id, string_agg('[' || (rank + 1) || '] ' || text, chr(10) || chr(10) ORDER BY rank) AS context,
         string_agg(doc_title || ' > ' || section_title, ';' ORDER BY rank) AS citations
  FROM reranked GROUP BY 1
)
SELECT query_id, context, citations, c_mktsegment AS status, CAST(CAST(c_nationkey AS INTEGER) AS VARCHAR) AS delay_minutes
FROM contexts JOIN questions USING (query_id) LEFT JOIN customer ON c_custkey = query_id
"""
