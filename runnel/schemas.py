"""Column lists and types of every table.

Event times are UTC wall-clock times in ``TIMESTAMP_NTZ``, so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

# Names and types of the data model.
RAW_DDL = """
    event_id STRING NOT NULL, session_id STRING, user_id STRING, timestamp STRING,
    service STRING, endpoint STRING, method STRING, status_code INT, latency_ms DOUBLE,
    region STRING, user_agent STRING, request_size_bytes BIGINT, response_size_bytes BIGINT,
    is_error BOOLEAN, error_message STRING, trace_id STRING
"""

CORRUPT_COL = "_corrupt_record"
#: Fields of a raw event that the data model does not name, as one JSON object.
UNKNOWN_COL = "_unknown_fields"
#: Partition of a load, so that a repeated load replaces itself.
LOAD_COL = "_load"
DATE_COL = "event_date"
#: The Bronze file in which a row arrived, by which batch and stream know each other's rejects.
FILE_COL = "_bronze_file"

BRONZE_DDL = f"""
    {RAW_DDL}, _ingested_at TIMESTAMP_NTZ, _source_file STRING, {CORRUPT_COL} STRING,
    {UNKNOWN_COL} STRING, event_date DATE
"""

#: Bronze as stored: rows of merged files have the name of the file that they came in.
STORED_DDL = f"{BRONZE_DDL}, {FILE_COL} STRING"

QUARANTINE_DDL = f"{BRONZE_DDL}, _dq_reason STRING, _dq_null_cols STRING, {FILE_COL} STRING"

SILVER_DDL = """
    event_id STRING NOT NULL, session_id STRING, user_id STRING, event_timestamp TIMESTAMP_NTZ,
    event_date DATE, event_hour INT, service STRING, endpoint STRING, method STRING,
    status_code INT, status_category STRING, latency_ms DOUBLE, region STRING,
    request_size_bytes BIGINT, response_size_bytes BIGINT, is_error BOOLEAN,
    error_message STRING, trace_id STRING, _ingested_at TIMESTAMP_NTZ, _source_file STRING
"""

#: Counts of one Bronze file. Files of one load share a name, so the date belongs to the key.
QUALITY_DDL = f"""
    {DATE_COL} DATE, {FILE_COL} STRING, total_rows BIGINT, valid_rows BIGINT,
    quarantined_rows BIGINT
"""

DAILY_KPIS_DDL = """
    event_date DATE NOT NULL, service STRING NOT NULL, region STRING NOT NULL,
    total_requests BIGINT, total_errors BIGINT, error_rate_pct DOUBLE, avg_latency_ms DOUBLE,
    p95_latency_ms DOUBLE, p99_latency_ms DOUBLE, unique_users BIGINT, unique_sessions BIGINT,
    total_request_bytes BIGINT, total_response_bytes BIGINT, _computed_at TIMESTAMP_NTZ
"""

SESSIONS_DDL = """
    derived_session_id STRING NOT NULL, user_id STRING, event_date DATE,
    session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ, total_events BIGINT,
    session_duration_mins DOUBLE, unique_endpoints BIGINT, errors_in_session BIGINT,
    avg_latency_ms DOUBLE, region STRING, _computed_at TIMESTAMP_NTZ
"""

CRITICAL_COLS = ["event_id", "user_id", "timestamp", "status_code"]

KPI_KEYS = ["event_date", "service", "region"]

SESSION_KEYS = ["derived_session_id", "event_date"]


def column_names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]


def struct(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema
