"""Bronze and Silver projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.columns import event_time, now_or, status_category, zoned_time
from runnel.operators.quality import dedup_latest, split_nulls, value_flags
from runnel.schemas import (
    CORRUPT_COL,
    CRITICAL_COLS,
    RAW_DDL,
    SILVER_DDL,
    UNKNOWN_COL,
    column_names,
)


def add_ingestion_metadata(
    df: DataFrame, source_file: str | None = None, ingested_at: Column | None = None
) -> DataFrame:
    """Adds ``_ingested_at`` and ``_source_file`` (given, else the file being read)."""
    source = F.lit(source_file) if source_file else F.col("_metadata.file_path")
    return df.withColumns({"_ingested_at": now_or(ingested_at), "_source_file": source})


def to_bronze(df: DataFrame) -> DataFrame:
    """Bronze columns, with the date taken from the raw time text.

    The text of a broken line and unknown fields, if the reader kept them, stay with the row.
    """
    kept = [c for c in [CORRUPT_COL, UNKNOWN_COL] if c in df.columns]
    return df.select(
        *column_names(RAW_DDL),
        "_ingested_at",
        "_source_file",
        *kept,
        F.col("timestamp").try_cast("date").alias("event_date"),
    )


def to_silver(df: DataFrame, keep_flags: bool = False) -> DataFrame:
    """Parses time, derives date, hour and status class, and projects the Silver columns."""
    typed = df.withColumn("event_timestamp", event_time("timestamp")).withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
            "status_category": status_category("status_code"),
        }
    )
    flags = ["_dq_flags"] if keep_flags else []
    return (value_flags(typed) if keep_flags else typed).select(*column_names(SILVER_DDL), *flags)


def clean(df: DataFrame, tie_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Bronze rows to Silver rows and quarantined rows.

    Of copies with equal times, ``tie_cols`` decide; without them the Silver row itself, so
    it is the same one whether the copies meet here or later in the Silver table.
    """
    valid, quarantine = split_nulls(df, CRITICAL_COLS)
    if tie_cols:
        return to_silver(dedup_latest(valid, tie_cols=tie_cols)), quarantine
    return dedup_latest(to_silver(valid)), quarantine


def drop_null_critical(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=CRITICAL_COLS)


def to_silver_sql(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The cast-only Silver variant: no deduplication, flags or source file."""
    time = zoned_time("timestamp")
    code = F.col("status_code").try_cast("int")
    computed = {
        "event_timestamp": time,
        "event_date": F.to_date(time),
        "event_hour": F.hour(time),
        "status_code": code,
        "status_category": status_category(code),
        "latency_ms": F.col("latency_ms").try_cast("double"),
        "request_size_bytes": F.col("request_size_bytes").try_cast("bigint"),
        "response_size_bytes": F.col("response_size_bytes").try_cast("bigint"),
        "is_error": F.col("is_error").try_cast("boolean"),
        "_ingested_at": now_or(ingested_at),
    }
    names = [c for c in column_names(SILVER_DDL) if c != "_source_file"]
    return drop_null_critical(df).select(
        *[computed.get(c, F.col(c)).alias(c) for c in names]
    )


def incremental(df: DataFrame, as_of: dt.date, days: int = 1) -> DataFrame:
    """Rows of ``as_of`` and the ``days`` before it, as a filter on the bare partition column."""
    return df.where(F.col("event_date") >= F.lit(as_of - dt.timedelta(days=days)))
