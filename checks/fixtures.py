"""Test inputs derived from the given tables, as SQL that both engines share.

``{text}`` is the engine's string type and ``{time}`` its rendering of a time as raw text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TIME = {
    "spark": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
    "duckdb": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')",
}

# HTTP-log view of `events`, with nulls, odd codes and odd latencies at known places.
LOGS_RAW = """
SELECT
  concat('evt_', CAST(event_id AS {text})) AS event_id,
  concat('sess_', CAST(user_id AS {text}), '_', CAST(CAST(ts AS DATE) AS {text})) AS session_id,
  CASE WHEN event_id % 50 = 7 THEN NULL
       ELSE concat('user_', CAST(user_id AS {text})) END AS user_id,
  CASE WHEN event_id % 211 = 9 THEN NULL ELSE {time} END AS timestamp,
  CASE user_id % 4 WHEN 0 THEN 'gateway' WHEN 1 THEN 'auth-service'
       WHEN 2 THEN 'order-service' ELSE 'product-service' END AS service,
  concat('/api/v1/', event_type, '/', CAST(event_id % 3 AS {text})) AS endpoint,
  CASE event_id % 4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT'
       ELSE 'DELETE' END AS method,
  CAST(CASE WHEN event_id % 97 = 5 THEN 999
       WHEN event_id % 307 = 11 THEN NULL
       WHEN event_type = 'error' AND event_id % 2 = 0 THEN 503
       WHEN event_type = 'error' THEN 404
       WHEN event_type = 'signup' THEN 201
       WHEN event_type = 'view' AND event_id % 10 = 3 THEN 304
       ELSE 200 END AS INT) AS status_code,
  CASE WHEN event_id % 101 = 4 THEN -value
       WHEN event_id % 103 = 6 THEN value * 10000
       ELSE value END AS latency_ms,
  CASE event_id % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1'
       ELSE 'ap-south-1' END AS region,
  CASE event_id % 2 WHEN 0 THEN 'agent-a' ELSE 'agent-b' END AS user_agent,
  100 + (event_id * 37) % 4900 AS request_size_bytes,
  200 + (event_id * 101) % 49800 AS response_size_bytes,
  event_type = 'error' AS is_error,
  CASE WHEN event_type = 'error' THEN
       CASE WHEN event_id % 2 = 0 THEN 'HTTPError 503' ELSE 'HTTPError 404' END
       END AS error_message,
  md5(CAST(event_id AS {text})) AS trace_id
FROM {events}
"""

# Every event, and a second copy of some of them.
LOGS_DUP = """
SELECT *, 1 AS ingest_seq FROM {logs}
UNION ALL
SELECT *, 2 AS ingest_seq FROM {logs} WHERE CAST(substring(event_id, 5) AS BIGINT) % 40 = 11
"""

# Snapshots before and after changes: unchanged, changed, nulled, new and missing keys.
CUST_V1 = """
SELECT c_custkey, c_mktsegment, c_acctbal FROM {customer} WHERE c_custkey % 20 <> 19
"""

CUST_V2 = """
SELECT c_custkey,
  CASE WHEN c_custkey % 7 = 3 THEN NULL WHEN c_custkey % 11 = 4 THEN 'RETAGGED'
       ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
FROM {customer} WHERE c_custkey % 25 <> 24
"""

#: A snapshot that comes late; in part as the first, in part as the second one.
CUST_LATE = """
SELECT c_custkey,
  CASE WHEN c_custkey % 7 = 3 THEN NULL WHEN c_custkey % 6 = 5 THEN 'MOVED'
       ELSE c_mktsegment END AS c_mktsegment, c_acctbal
FROM {customer} WHERE c_custkey % 30 <> 17
"""

INGESTED = "2024-02-01 00:00:00"
COMPUTED = "2024-02-02 00:00:00"
LOADS = ["2024-01-01 00:00:00", "2024-02-01 00:00:00"]
#: Times of a third load, with the first snapshot again, and of two that come late.
THIRD, LATE = "2024-03-01 00:00:00", ["2024-02-15 00:00:00", "2024-01-15 00:00:00"]


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = LOGS_RAW.format(text="STRING", time=RAW_TIME["spark"], events="{events}")
    return spark.sql(text, events=_table(spark, sf_dir, "events"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log view with fixed audit columns."""
    audit = {"_ingested_at": ntz(INGESTED), "_source_file": F.lit("events")}
    return logs_raw(spark, sf_dir).withColumns(audit)


def logs_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LOGS_DUP, logs=logs_raw(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    table = _table(spark, sf_dir, "customer")
    return spark.sql(CUST_V1, customer=table), spark.sql(CUST_V2, customer=table)


def late_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CUST_LATE, customer=_table(spark, sf_dir, "customer"))
