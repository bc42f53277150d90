"""Daily service indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.columns import error_sum, now_or, percent, rounded, same_row
from runnel.operators.percentiles import exact_percentiles
from runnel.schemas import DAILY_KPIS_DDL, KPI_KEYS, column_names

#: Columns that the indicators are computed from, beside their keys.
KPI_INPUTS = [
    "event_id", "user_id", "session_id", "is_error", "latency_ms",
    "request_size_bytes", "response_size_bytes",
]
LATENCY_PROBS = {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def kpi_totals(silver: DataFrame) -> DataFrame:
    """Counts, sums and means: fixed-size buffers, merged before the shuffle."""
    requests = F.count("event_id")
    return silver.groupBy(*KPI_KEYS).agg(
        requests.alias("total_requests"),
        error_sum().cast("bigint").alias("total_errors"),
        rounded(percent(error_sum(), requests), 2).alias("error_rate_pct"),
        rounded(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        F.sum("request_size_bytes").alias("total_request_bytes"),
        F.sum("response_size_bytes").alias("total_response_bytes"),
    )


def kpi_uniques(silver: DataFrame) -> DataFrame:
    """Exact distinct counts. Users are spread over tasks before they are counted.

    Kept apart from the totals, whose buffers would otherwise travel with every user.
    """
    return silver.groupBy(*KPI_KEYS).agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two frames of one row per cell, side by side."""
    added = [F.col(f"r.{c}") for c in right.columns if c not in KPI_KEYS]
    joined = left.alias("l").join(right.alias("r"), same_row(KPI_KEYS, "l", "r"), "left")
    return joined.select("l.*", *added)


def kpi_counts(silver: DataFrame) -> DataFrame:
    """The indicators that need no percentile."""
    return _beside(kpi_totals(silver), kpi_uniques(silver))


def approx_percentiles(silver: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Mergeable sketches: an existing value whose rank is off by at most 1/accuracy.

    Kept apart from the distinct counts, which would give every user its own sketch.
    """
    sketched = [
        F.percentile_approx("latency_ms", p, accuracy).alias(name)
        for name, p in LATENCY_PROBS.items()
    ]
    return silver.groupBy(*KPI_KEYS).agg(*sketched)


def daily_kpis(
    silver: DataFrame,
    computed_at: Column | None = None,
    exact: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Indicators per date, service and region, with sketched or exact percentiles."""
    if exact:
        tails = exact_percentiles(silver, KPI_KEYS, "latency_ms", LATENCY_PROBS)
    else:
        tails = approx_percentiles(silver, accuracy)
    tails = tails.select(*KPI_KEYS, *[rounded(F.col(n), 2).alias(n) for n in LATENCY_PROBS])
    return (
        _beside(kpi_counts(silver), tails)
        .withColumn("_computed_at", now_or(computed_at))
        .select(*column_names(DAILY_KPIS_DDL))
    )


def status_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("status_category").agg(F.count(F.lit(1)).alias("cnt"))

