"""Dashboard queries over the Silver and Gold tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runnel.functions.columns import day_name, error_sum, percent, rounded
from runnel.operators.gold import LATENCY_PROBS
from runnel.operators.mergeable import distinct_counts, merged_percentiles


def error_trend(kpis: DataFrame) -> DataFrame:
    requests, errors = F.sum("total_requests"), F.sum("total_errors")
    return (
        kpis.groupBy("event_date", "service")
        .agg(
            requests.alias("total_requests"),
            errors.alias("total_errors"),
            rounded(percent(errors, requests), 2).alias("error_rate_pct"),
        )
        .orderBy(F.desc("event_date"), "service")
    )


def latency_by_service(kpis: DataFrame) -> DataFrame:
    return (
        kpis.groupBy("event_date", "service", "region")
        .agg(
            rounded(F.avg("avg_latency_ms"), 2).alias("avg_latency_ms"),
            rounded(F.max("p95_latency_ms"), 2).alias("p95_latency_ms"),
            rounded(F.max("p99_latency_ms"), 2).alias("p99_latency_ms"),
        )
        .orderBy(F.desc("p95_latency_ms"))
    )


def daily_active(kpis: DataFrame) -> DataFrame:
    """Sums of the distinct counts per service and region: a user of two services counts twice."""
    return (
        kpis.groupBy("event_date")
        .agg(
            F.sum("unique_users").alias("daily_active_users"),
            F.sum("unique_sessions").alias("daily_sessions"),
        )
        .orderBy("event_date")
    )


def daily_active_exact(bitmaps: DataFrame) -> DataFrame:
    """Users and sessions per date from the stored bitmaps: one of two services counts once."""
    counted = distinct_counts(bitmaps, ["event_date"])
    return (
        counted.groupBy("event_date")
        .agg(
            F.coalesce(F.sum(F.when(F.col("kind") == "user", F.col("n"))), F.lit(0)).alias(
                "daily_active_users"
            ),
            F.coalesce(F.sum(F.when(F.col("kind") == "session", F.col("n"))), F.lit(0)).alias(
                "daily_sessions"
            ),
        )
        .orderBy("event_date")
    )


def latency_tails(sketches: DataFrame, by: Sequence[str] = ("service",)) -> DataFrame:
    """Latency percentiles of whole groups of cells, from the stored sketches."""
    return merged_percentiles(sketches, by, LATENCY_PROBS).orderBy(*by)


def top_endpoints(silver: DataFrame, n: int = 10) -> DataFrame:
    requests = F.count(F.lit(1))
    return (
        silver.groupBy("endpoint")
        .agg(
            requests.alias("total_requests"),
            rounded(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
            rounded(percent(error_sum(), requests), 2).alias("error_rate_pct"),
        )
        .orderBy(F.desc("total_requests"), "endpoint")
        .limit(n)
    )


def region_traffic(kpis: DataFrame) -> DataFrame:
    """Share of all requests per region; the total is taken over the few aggregated rows."""
    regions = kpis.groupBy("region").agg(
        F.sum("total_requests").alias("total_requests"),
        rounded(F.avg("avg_latency_ms"), 2).alias("avg_latency_ms"),
        rounded(F.avg("error_rate_pct"), 2).alias("avg_error_rate_pct"),
    )
    whole = F.sum("total_requests").over(Window.partitionBy())
    return regions.select(
        "region",
        "total_requests",
        rounded(percent(F.col("total_requests"), whole), 2).alias("traffic_pct"),
        "avg_latency_ms",
        "avg_error_rate_pct",
    ).orderBy(F.desc("total_requests"))


def error_heatmap(silver: DataFrame) -> DataFrame:
    requests = F.count(F.lit(1))
    return (
        silver.groupBy(
            "event_hour",
            day_name("event_date").alias("day_name"),
            F.dayofweek("event_date").alias("day_num"),
        )
        .agg(
            requests.alias("total_requests"),
            error_sum().alias("total_errors"),
            rounded(percent(error_sum(), requests), 2).alias("error_rate_pct"),
        )
        .orderBy("day_num", "event_hour")
    )


def session_buckets(sessions: DataFrame) -> DataFrame:
    mins = F.col("session_duration_mins")
    # Limits and names of the buckets.
    bucket = (
        F.when(mins < 1, "< 1 min")
        .when(mins < 5, "1-5 mins")
        .when(mins < 15, "5-15 mins")
        .when(mins < 30, "15-30 mins")
        .otherwise("> 30 mins")
    )
    return (
        sessions.groupBy(bucket.alias("duration_bucket"))
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            rounded(F.avg("total_events"), 1).alias("avg_events_per_session"),
            rounded(F.avg("errors_in_session"), 2).alias("avg_errors_per_session"),
        )
        .orderBy(F.desc("session_count"))
    )


def summary_counters(kpis: DataFrame) -> DataFrame:
    return kpis.agg(
        F.sum("total_requests").alias("total_requests"),
        F.sum("total_errors").alias("total_errors"),
        rounded(F.avg("error_rate_pct"), 2).alias("avg_error_rate_pct"),
        rounded(F.avg("avg_latency_ms"), 2).alias("avg_latency_ms"),
        F.sum("unique_users").alias("total_users"),
        F.sum("unique_sessions").alias("total_sessions"),
    )


def pipeline_health(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and last update per table, given as name -> (frame, time column)."""
    rows = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.max(at).alias("last_updated"),
        )
        for name, (df, at) in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def latest_kpis(kpis: DataFrame, n: int = 10) -> DataFrame:
    return kpis.orderBy(F.desc("event_date"), "service", "region").limit(n)


def longest_sessions(sessions: DataFrame, n: int = 10) -> DataFrame:
    order = [F.desc("session_duration_mins"), F.col("derived_session_id"), F.col("event_date")]
    return sessions.orderBy(*order).limit(n)
