"""The same results as plain SQL for DuckDB, over the same tables."""

from __future__ import annotations

from checks.fixtures import (
    COMPUTED,
    CUST_LATE,
    CUST_V1,
    CUST_V2,
    INGESTED,
    LATE,
    LOADS,
    LOGS_DUP,
    LOGS_RAW,
    RAW_TIME,
    THIRD,
)


def rounded(x: str, places: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"


def seconds(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


def status(code: str) -> str:
    return (
        f"CASE WHEN {code} BETWEEN 200 AND 299 THEN '2xx' WHEN {code} BETWEEN 300 AND 399 "
        f"THEN '3xx' WHEN {code} BETWEEN 400 AND 499 THEN '4xx' "
        f"WHEN {code} BETWEEN 500 AND 599 THEN '5xx' ELSE 'unknown' END"
    )


RAW = [
    "event_id", "session_id", "user_id", "timestamp", "service", "endpoint", "method",
    "status_code", "latency_ms", "region", "user_agent", "request_size_bytes",
    "response_size_bytes", "is_error", "error_message", "trace_id",
]
RAW_LIST = ", ".join(RAW)
ANY_NULL = "(event_id IS NULL OR user_id IS NULL OR timestamp IS NULL OR status_code IS NULL)"
ERRORS = "CAST(sum(CAST(is_error AS INT)) AS BIGINT)"
PARSED = "strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%gZ')"

SILVER_SQL = f"""
SELECT event_id, session_id, user_id, {PARSED} AS event_timestamp,
  CAST({PARSED} AS DATE) AS event_date, CAST(hour({PARSED}) AS INT) AS event_hour,
  service, endpoint, method, status_code, {status('status_code')} AS status_category,
  latency_ms, region, request_size_bytes, response_size_bytes, is_error, error_message,
  trace_id, TIMESTAMP '{INGESTED}' AS _ingested_at
FROM logs_raw WHERE NOT {ANY_NULL}
"""

SKEWED = """
SELECT * REPLACE (CASE WHEN CAST(substring(event_id, 5) AS BIGINT) % 3 = 0 THEN 'user_hot'
  ELSE user_id END AS user_id) FROM silver
"""

CROWDED = """
SELECT * REPLACE (CASE WHEN hot THEN DATE '2024-01-20' ELSE event_date END AS event_date,
  CASE WHEN hot THEN 'gateway' ELSE service END AS service,
  CASE WHEN hot THEN 'us-east-1' ELSE region END AS region)
FROM (SELECT *, CAST(substring(event_id, 5) AS BIGINT) % 3 = 0 AS hot FROM silver)
"""

KPIS = f"""
SELECT event_date, service, region, count(event_id) AS total_requests,
  {ERRORS} AS total_errors, {rounded(percent(ERRORS, 'count(event_id)'))} AS error_rate_pct,
  {rounded('avg(latency_ms)')} AS avg_latency_ms,
  {rounded('quantile_X(latency_ms, 0.95)')} AS p95_latency_ms,
  {rounded('quantile_X(latency_ms, 0.99)')} AS p99_latency_ms,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
  CAST(sum(request_size_bytes) AS BIGINT) AS total_request_bytes,
  CAST(sum(response_size_bytes) AS BIGINT) AS total_response_bytes,
  TIMESTAMP '{COMPUTED}' AS _computed_at
FROM silver GROUP BY event_date, service, region
"""

GAPS = f"""
SELECT *, CAST({seconds('event_timestamp')} - {seconds('prev_ts')} AS DOUBLE) / 60 AS gap_mins,
  prev_ts IS NULL OR {seconds('event_timestamp')} - {seconds('prev_ts')} > 1800
    AS is_new_session
FROM (SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id
        ORDER BY event_timestamp, event_id) AS prev_ts FROM <events>)
"""

NUMBERED = """
SELECT *, concat(user_id, '_', CAST(session_num AS VARCHAR)) AS derived_session_id
FROM (SELECT *, CAST(sum(CAST(is_new_session AS INT)) OVER (PARTITION BY user_id
        ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_num
      FROM gaps)
"""

ORIGINS = f"""
SELECT * REPLACE (concat(user_id, '_', CAST(min({seconds('event_timestamp')}) OVER (
  PARTITION BY user_id, session_num) AS VARCHAR)) AS derived_session_id) FROM numbered
"""


def summary(events: str, keys: str = "derived_session_id, user_id", count: str = "event_id") -> str:
    mins = f"CAST({seconds('max(event_timestamp)')} - {seconds('min(event_timestamp)')} AS DOUBLE)"
    return f"""
SELECT {keys}, event_date, min(event_timestamp) AS session_start,
  max(event_timestamp) AS session_end, count({count}) AS total_events,
  {rounded(mins + ' / 60')} AS session_duration_mins,
  count(DISTINCT endpoint) AS unique_endpoints, {ERRORS} AS errors_in_session,
  {rounded('avg(latency_ms)')} AS avg_latency_ms,
  arg_min(region, (event_timestamp, event_id)) AS region,
  TIMESTAMP '{COMPUTED}' AS _computed_at
FROM {events} GROUP BY ALL
"""


CHECKSUM = (
    "md5(CAST(to_json([CAST(c_mktsegment AS VARCHAR), CAST(c_acctbal AS VARCHAR)]) AS VARCHAR))"
)


def staged(snapshot: str, at: str) -> str:
    return f"""
SELECT *, TIMESTAMP '{at}' AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date,
  true AS is_current, {CHECKSUM} AS _checksum FROM {snapshot}
"""


CHANGED = (
    "(n.c_custkey IS NOT NULL AND (h.c_mktsegment IS DISTINCT FROM n.c_mktsegment "
    "OR h.c_acctbal IS DISTINCT FROM n.c_acctbal))"
)

EXPIRED = f"""
SELECT h.* REPLACE (CASE WHEN {CHANGED} THEN TIMESTAMP '{LOADS[1]}' END AS effective_end_date,
  NOT {CHANGED} AS is_current)
FROM h LEFT JOIN cust_v2 n USING (c_custkey)
"""

NEW_ROWS = """
SELECT s.* FROM s2 s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.c_custkey = s.c_custkey
  AND h._checksum = s._checksum)
"""

CTES = {
    "logs_raw": LOGS_RAW.format(text="VARCHAR", time=RAW_TIME["duckdb"], events="events"),
    "logs_dup": LOGS_DUP.format(logs="logs_raw"),
    "silver_sql": SILVER_SQL,
    "silver": "SELECT *, 'events' AS _source_file FROM silver_sql",
    "skewed": SKEWED,
    "kpis": KPIS.replace("quantile_X", "quantile_cont"),
    "kpis_approx": KPIS.replace("quantile_X", "quantile_disc"),
    "crowded": CROWDED,
    "kpis_crowded": KPIS.replace("quantile_X", "quantile_cont").replace(
        "FROM silver", "FROM crowded"
    ),
    "gaps": GAPS.replace("<events>", "silver"),
    "numbered": NUMBERED,
    "sessions": summary("numbered"),
    "origins": ORIGINS,
    "cust_v1": CUST_V1.format(customer="customer"),
    "cust_v2": CUST_V2.format(customer="customer"),
    "h": staged("cust_v1", LOADS[0]),
    "s2": staged("cust_v2", LOADS[1]),
    "expired": EXPIRED,
    "new_rows": NEW_ROWS,
    "applied": "SELECT * FROM expired UNION ALL BY NAME SELECT * FROM new_rows",
}

# All five snapshots in the order of their times; a version starts where a value changes.
CTES["cust_late"] = CUST_LATE.format(customer="customer")
CTES["seen"] = " UNION ALL ".join(
    f"SELECT *, TIMESTAMP '{at}' AS loaded FROM {name}"
    for name, at in [
        ("cust_v1", LOADS[0]), ("cust_v2", LOADS[1]), ("cust_v1", THIRD),
        ("cust_late", LATE[0]), ("cust_late", LATE[1]),
    ]
)
CTES["turns"] = """
SELECT *, lag(loaded) OVER line IS NULL OR lag(c_mktsegment) OVER line IS DISTINCT FROM c_mktsegment
  OR lag(c_acctbal) OVER line IS DISTINCT FROM c_acctbal AS turned
FROM seen WINDOW line AS (PARTITION BY c_custkey ORDER BY loaded)
"""
CTES["chained"] = f"""
SELECT c_custkey, c_mktsegment, c_acctbal, loaded AS effective_start_date,
  lead(loaded) OVER line AS effective_end_date, lead(loaded) OVER line IS NULL AS is_current,
  {CHECKSUM} AS _checksum
FROM turns WHERE turned WINDOW line AS (PARTITION BY c_custkey ORDER BY loaded)
"""
LATE_NAMES = ["cust_v1", "cust_v2", "cust_late", "seen", "turns", "chained"]

LOG_NAMES = ["logs_raw", "silver_sql", "silver"]
SESSION_NAMES = [*LOG_NAMES, "gaps", "numbered", "sessions"]
HISTORY_NAMES = ["cust_v1", "cust_v2", "h", "s2", "expired", "new_rows", "applied"]


def sql(names: list[str], body: str, **over: str) -> str:
    texts = {**CTES, **over}
    return "WITH " + ",\n".join(f"{n} AS ({texts[n]})" for n in names) + "\n" + body


def logs(body: str, *more: str, **over: str) -> str:
    return sql([*LOG_NAMES, *more], body, **over)


def past(body: str) -> str:
    return sql(HISTORY_NAMES, body)


SKEWED_GAPS = {"gaps": GAPS.replace("<events>", "skewed")}
GAP_COLS = "event_id, user_id, event_timestamp, prev_ts, gap_mins, is_new_session"
NUM_COLS = "event_id, user_id, session_num, derived_session_id"
DATED = f"TIMESTAMP '{INGESTED}' AS _ingested_at, CAST(substring(timestamp, 1, 10) AS DATE)"

ORACLE: dict[str, str] = {
    "bronze_ingest": sql(
        ["logs_raw"],
        f"SELECT {RAW_LIST}, 'landing' AS _source_file, {DATED} AS event_date FROM logs_raw",
    ),
    "bronze_sql_scan": sql(["logs_raw"], "SELECT * FROM logs_raw"),
    "bronze_sample": sql(["logs_raw"], "SELECT * FROM logs_raw ORDER BY event_id LIMIT 5"),
    "land_partitioned_json": sql(
        ["logs_raw"],
        f"SELECT *, CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month, "
        f"CAST(day(t) AS INT) AS day FROM (SELECT *, TIMESTAMP '{INGESTED}' AS t FROM logs_raw)"
        .replace("SELECT *, CAST", f"SELECT {RAW_LIST}, CAST", 1),
    ),
    "silver_roundtrip": logs("SELECT * FROM silver"),
    "catalog_tables": logs(
        "SELECT 'raw_logs' AS table_name, CAST(0 AS BIGINT) AS cnt UNION ALL "
        "SELECT 'logs_cleaned', count(*) FROM silver UNION ALL "
        "SELECT 'daily_kpis', 0 UNION ALL SELECT 'session_summary', 0"
    ),
    "append_evolving": logs(
        "SELECT * REPLACE (CASE WHEN event_date > DATE '2024-01-20' THEN trace_id END AS trace_id, "
        "CASE WHEN event_date > DATE '2024-01-20' THEN region END AS region) FROM silver"
    ),
    "silver_clean": logs("SELECT * FROM silver"),
    "bronze_unknown_fields": sql(
        ["logs_raw"],
        "SELECT 'canary' AS \"column\", 'STRING' AS kind, count(*) AS non_null FROM logs_raw "
        "WHERE CAST(substring(event_id, 5) AS BIGINT) % 5 = 0 "
        "UNION ALL SELECT 'shard', 'OBJECT<n: BIGINT>', count(*) FROM logs_raw "
        "UNION ALL SELECT 'level', 'VARIANT', count(*) FROM logs_raw",
    ),
    "bronze_promoted_fields": sql(
        ["logs_raw"],
        "SELECT event_id, n AS shard, CASE WHEN n % 4 <> 1 THEN n END AS level, "
        "CASE WHEN n % 5 = 0 AND n % 4 = 1 THEN '{\"canary\":\"x\",\"level\":\"high\"}' "
        "WHEN n % 5 = 0 THEN '{\"canary\":\"x\"}' "
        "WHEN n % 4 = 1 THEN '{\"level\":\"high\"}' END AS _unknown_fields "
        "FROM (SELECT event_id, CAST(substring(event_id, 5) AS BIGINT) AS n FROM logs_raw)",
    ),
    "upsert_evolving": logs(
        "SELECT *, CASE WHEN event_date < DATE '2024-01-19' THEN 'old' END AS note FROM kpis",
        "kpis",
    ),
    "silver_late_events": sql(
        ["logs_raw", "silver_sql"], "SELECT * EXCLUDE (_ingested_at) FROM silver_sql"
    ),
    "gold_late_events": logs("SELECT * EXCLUDE (_computed_at) FROM kpis", "kpis"),
    "flow_by_name": logs(
        "SELECT 'raw_logs' AS table_name, count(*) + count(*) FILTER (timestamp IS NOT NULL "
        "AND CAST(substring(event_id, 5) AS BIGINT) % 40 = 11) AS cnt FROM logs_raw UNION ALL "
        "SELECT 'logs_cleaned', count(*) FROM silver UNION ALL "
        "SELECT 'daily_kpis', count(*) FROM kpis",
        "kpis",
    ),
    "silver_sql": sql(["logs_raw", "silver_sql"], "SELECT * FROM silver_sql"),
    "incremental_read": logs(
        "SELECT event_id, event_date FROM silver WHERE event_date >= DATE '2024-01-29'"
    ),
    "status_category": sql(
        ["logs_raw"],
        f"SELECT event_id, status_code, {status('status_code')} AS status_category FROM logs_raw",
    ),
    "status_counts": logs(
        "SELECT status_category, count(*) AS cnt FROM silver GROUP BY status_category"
    ),
    "dq_null_valid": sql(["logs_raw"], f"SELECT * FROM logs_raw WHERE NOT {ANY_NULL}"),
    "dq_null_quarantine": sql(
        ["logs_raw"],
        "SELECT *, 'Null in: [''event_id'', ''user_id'', ''timestamp'', ''status_code'']' "
        "AS _dq_reason, concat_ws(',', CASE WHEN event_id IS NULL THEN 'event_id' END, "
        "CASE WHEN user_id IS NULL THEN 'user_id' END, "
        "CASE WHEN timestamp IS NULL THEN 'timestamp' END, "
        "CASE WHEN status_code IS NULL THEN 'status_code' END) AS _dq_null_cols "
        f"FROM logs_raw WHERE {ANY_NULL}",
    ),
    "dedup_latest": sql(
        ["logs_raw", "logs_dup"],
        "SELECT * FROM logs_dup QUALIFY row_number() OVER (PARTITION BY event_id "
        "ORDER BY ingest_seq DESC, trace_id) = 1",
    ),
    "dq_value_flags": sql(
        ["logs_raw"],
        "SELECT event_id, status_code, latency_ms, concat("
        "CASE WHEN latency_ms < 0 THEN 'negative_latency,' ELSE '' END, "
        "CASE WHEN status_code < 100 OR status_code > 599 THEN 'invalid_status,' ELSE '' END, "
        "CASE WHEN latency_ms > 60000 THEN 'extreme_latency,' ELSE '' END) AS _dq_flags "
        "FROM logs_raw",
    ),
    "dq_summary": sql(
        ["logs_raw", "logs_dup"],
        f"SELECT count(*) AS total_rows, count(*) FILTER (NOT {ANY_NULL}) AS valid_rows, "
        f"count(*) FILTER ({ANY_NULL}) AS quarantined_rows, count(*) FILTER (NOT {ANY_NULL}) - "
        f"count(DISTINCT event_id) FILTER (NOT {ANY_NULL}) AS duplicates_removed FROM logs_dup",
    ),
    "schema_drift": sql(
        ["logs_raw"],
        "SELECT 'user_agent' AS \"column\", 'missing' AS drift, 'string' AS expected_type, "
        "CAST(NULL AS VARCHAR) AS actual_type, CAST(0 AS BIGINT) AS non_null, "
        "CAST(0 AS BIGINT) AS uncastable UNION ALL "
        "SELECT 'tenant', 'extra', NULL, 'string', count(*) FILTER (region <> 'us-east-1'), 0 "
        "FROM logs_raw UNION ALL "
        "SELECT 'status_code', 'type', 'int', 'string', count(status_code), "
        "count(*) FILTER (status_code = 999) FROM logs_raw",
    ),
    "table_stats": sql(
        ["logs_raw"], "SELECT 'raw_logs' AS label, count(*) AS row_count FROM logs_raw"
    ),
    "daily_kpis": logs("SELECT * FROM kpis", "kpis"),
    "daily_kpis_skewed": logs("SELECT * FROM kpis_crowded", "crowded", "kpis_crowded"),
    "daily_kpis_approx": logs("SELECT * FROM kpis_approx", "kpis_approx"),
    "kpis_latest": logs(
        "SELECT * FROM kpis ORDER BY event_date DESC, service, region LIMIT 10", "kpis"
    ),
    "session_gaps": logs(f"SELECT {GAP_COLS} FROM gaps", "gaps"),
    "session_gaps_skewed": logs(
        f"SELECT {GAP_COLS} FROM gaps", "skewed", "gaps", **SKEWED_GAPS
    ),
    "sessionize": logs(f"SELECT {NUM_COLS} FROM numbered", "gaps", "numbered"),
    "sessionize_skewed": logs(
        f"SELECT {NUM_COLS} FROM numbered", "skewed", "gaps", "numbered", **SKEWED_GAPS
    ),
    "sessions_idle": sql(SESSION_NAMES, "SELECT * FROM sessions"),
    "sessions_idle_skewed": logs(
        "SELECT * FROM sessions", "skewed", "gaps", "numbered", "sessions", **SKEWED_GAPS
    ),
    "sessions_many_hot": sql(SESSION_NAMES, "SELECT * FROM sessions"),
    "sessions_client": sql(
        ["logs_raw", "silver_sql"],
        "SELECT concat(user_id, '_', session_id) AS derived_session_id, * FROM ("
        + summary("silver_sql", "user_id, session_id", "*")
        + ")",
    ),
    "sessions_longest": sql(
        SESSION_NAMES,
        "SELECT * FROM sessions ORDER BY session_duration_mins DESC, derived_session_id, "
        "event_date LIMIT 10",
    ),
    "sessions_resumed": sql([*LOG_NAMES, "gaps", "numbered", "origins"], summary("origins")),
    "kpi_error_trend": logs(
        "SELECT event_date, service, CAST(sum(total_requests) AS BIGINT) AS total_requests, "
        "CAST(sum(total_errors) AS BIGINT) AS total_errors, "
        f"{rounded(percent('sum(total_errors)', 'sum(total_requests)'))} AS error_rate_pct "
        "FROM kpis GROUP BY event_date, service",
        "kpis",
    ),
    "kpi_latency_by_service": logs(
        f"SELECT event_date, service, region, {rounded('avg(avg_latency_ms)')} AS avg_latency_ms, "
        f"{rounded('max(p95_latency_ms)')} AS p95_latency_ms, "
        f"{rounded('max(p99_latency_ms)')} AS p99_latency_ms "
        "FROM kpis GROUP BY event_date, service, region",
        "kpis",
    ),
    "kpi_daily_active": logs(
        "SELECT event_date, CAST(sum(unique_users) AS BIGINT) AS daily_active_users, "
        "CAST(sum(unique_sessions) AS BIGINT) AS daily_sessions FROM kpis GROUP BY event_date",
        "kpis",
    ),
    "daily_active_exact": logs(
        "SELECT event_date, count(DISTINCT user_id) AS daily_active_users, "
        "count(DISTINCT session_id) AS daily_sessions FROM silver GROUP BY event_date"
    ),
    "latency_tails": logs(
        "SELECT service, count(latency_ms) AS n, true AS p95_within, true AS p99_within "
        "FROM silver WHERE latency_ms IS NOT NULL GROUP BY service"
    ),
    "kpi_top_endpoints": logs(
        f"SELECT endpoint, count(*) AS total_requests, {rounded('avg(latency_ms)')} "
        f"AS avg_latency_ms, {rounded(percent(ERRORS, 'count(*)'))} AS error_rate_pct "
        "FROM silver GROUP BY endpoint ORDER BY total_requests DESC, endpoint LIMIT 10"
    ),
    "kpi_region_traffic": logs(
        "SELECT region, CAST(sum(total_requests) AS BIGINT) AS total_requests, "
        f"{rounded(percent('sum(total_requests)', 'sum(sum(total_requests)) OVER ()'))} "
        f"AS traffic_pct, {rounded('avg(avg_latency_ms)')} AS avg_latency_ms, "
        f"{rounded('avg(error_rate_pct)')} AS avg_error_rate_pct FROM kpis GROUP BY region",
        "kpis",
    ),
    "kpi_error_heatmap": logs(
        "SELECT event_hour, dayname(event_date) AS day_name, "
        "CAST(dayofweek(event_date) + 1 AS INT) AS day_num, count(*) AS total_requests, "
        f"{ERRORS} AS total_errors, {rounded(percent(ERRORS, 'count(*)'))} AS error_rate_pct "
        "FROM silver GROUP BY ALL"
    ),
    "kpi_session_buckets": sql(
        SESSION_NAMES,
        "SELECT CASE WHEN session_duration_mins < 1 THEN '< 1 min' "
        "WHEN session_duration_mins < 5 THEN '1-5 mins' "
        "WHEN session_duration_mins < 15 THEN '5-15 mins' "
        "WHEN session_duration_mins < 30 THEN '15-30 mins' ELSE '> 30 mins' END "
        f"AS duration_bucket, count(*) AS session_count, {rounded('avg(total_events)', 1)} "
        f"AS avg_events_per_session, {rounded('avg(errors_in_session)')} "
        "AS avg_errors_per_session FROM sessions GROUP BY duration_bucket",
    ),
    "kpi_summary": logs(
        "SELECT CAST(sum(total_requests) AS BIGINT) AS total_requests, "
        "CAST(sum(total_errors) AS BIGINT) AS total_errors, "
        f"{rounded('avg(error_rate_pct)')} AS avg_error_rate_pct, "
        f"{rounded('avg(avg_latency_ms)')} AS avg_latency_ms, "
        "CAST(sum(unique_users) AS BIGINT) AS total_users, "
        "CAST(sum(unique_sessions) AS BIGINT) AS total_sessions FROM kpis",
        "kpis",
    ),
    "pipeline_health": sql(
        [*SESSION_NAMES, "kpis"],
        f"SELECT 'bronze.raw_logs' AS table_name, count(*) AS row_count, "
        f"TIMESTAMP '{INGESTED}' AS last_updated FROM logs_raw UNION ALL "
        "SELECT 'silver.logs_cleaned', count(*), max(_ingested_at) FROM silver UNION ALL "
        "SELECT 'gold.daily_kpis', count(*), max(_computed_at) FROM kpis UNION ALL "
        "SELECT 'gold.session_summary', count(*), max(_computed_at) FROM sessions",
    ),
    "sql_tables_health": logs(
        f"SELECT 'bronze.raw_logs' AS table_name, count(*) AS row_count, "
        f"TIMESTAMP '{COMPUTED}' AS last_updated FROM logs_raw UNION ALL "
        f"SELECT 'silver.logs_cleaned', count(*), TIMESTAMP '{COMPUTED}' FROM silver_sql UNION ALL "
        "SELECT 'gold.daily_kpis', count(*), max(_computed_at) FROM kpis UNION ALL "
        f"SELECT 'gold.session_summary', count(*), TIMESTAMP '{COMPUTED}' FROM "
        "(SELECT DISTINCT user_id, session_id, event_date FROM silver_sql)",
        "kpis",
    ),
    "kpis_upsert": logs("SELECT * FROM kpis", "kpis"),
    "sessions_upsert": sql(SESSION_NAMES, "SELECT * FROM sessions"),
    "scd2_initial": past("SELECT * FROM h"),
    "scd2_checksum": past("SELECT c_custkey, _checksum FROM s2"),
    "scd2_expire": past("SELECT * FROM expired"),
    "scd2_new_rows": past("SELECT * FROM new_rows"),
    "scd2_apply": past("SELECT * FROM applied"),
    "scd2_table": past("SELECT * FROM applied"),
    "scd2_version": past(
        "SELECT c_custkey, c_mktsegment, c_acctbal FROM applied WHERE is_current"
    ),
    "scd2_late_load": sql(LATE_NAMES, "SELECT * FROM chained"),
    "scd2_current": past("SELECT * FROM applied WHERE is_current"),
    "history_as_of": past(
        "SELECT * FROM applied WHERE effective_start_date <= TIMESTAMP '2024-01-15 12:00:00' AND "
        "(effective_end_date IS NULL OR effective_end_date > TIMESTAMP '2024-01-15 12:00:00')"
    ),
    "history_as_of_version": past(
        f"SELECT * FROM applied WHERE effective_start_date <= TIMESTAMP '{LOADS[1]}' AND "
        f"(effective_end_date IS NULL OR effective_end_date > TIMESTAMP '{LOADS[1]}')"
    ),
    "history_prune": past(
        "SELECT * FROM applied WHERE is_current OR "
        "effective_end_date >= TIMESTAMP '2024-02-20 00:00:00' - INTERVAL 168 HOUR"
    ),
    "compact_zorder": logs("SELECT * FROM silver"),
    "compact_hilbert": logs("SELECT * FROM silver"),
    "events_of_users": logs(
        "SELECT * FROM silver WHERE user_id IN "
        "(SELECT DISTINCT user_id FROM silver ORDER BY user_id LIMIT 3)"
    ),
    "silver_by_date": logs("SELECT event_date, count(*) AS cnt FROM silver GROUP BY event_date"),
    "stream_bronze": sql(["logs_raw"], f"SELECT {RAW_LIST}, {DATED} AS event_date FROM logs_raw"),
    "bronze_upkeep": sql(["logs_raw"], f"SELECT {RAW_LIST}, {DATED} AS event_date FROM logs_raw"),
    "silver_after_upkeep": sql(["logs_raw", "silver_sql"], "SELECT * FROM silver_sql"),
    "files_after_upkeep": sql(
        ["logs_raw"],
        "SELECT event_date, CAST(1 AS BIGINT) AS files, count(*) AS cnt "
        f"FROM (SELECT {DATED} AS event_date FROM logs_raw) GROUP BY event_date",
    ),
    "stream_silver": sql(["logs_raw", "silver_sql"], "SELECT * FROM silver_sql"),
    "stream_gold": logs("SELECT * FROM kpis", "kpis"),
    "stream_sessions": sql([*LOG_NAMES, "gaps", "numbered", "origins"], summary("origins")),
}

ORACLE["stream_quarantine"] = ORACLE["dq_null_quarantine"]
ORACLE["stream_quality"] = ORACLE["dq_summary"]
