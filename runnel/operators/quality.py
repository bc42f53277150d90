"""Data-quality operators: null split, deduplication, value flags, counts and schema drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from runnel.schemas import CRITICAL_COLS, DATE_COL, FILE_COL


def any_null(cols: Sequence[str]) -> Column:
    """Whether a row lacks one of the values, as one SQL predicate."""
    return F.expr(" OR ".join(f"`{c}` IS NULL" for c in cols) or "false")


def split_nulls(
    df: DataFrame, cols: Sequence[str] = CRITICAL_COLS
) -> tuple[DataFrame, DataFrame]:
    """Rows with all of ``cols`` set, and the others with the reason and the null columns."""
    null_names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    # Fixed value: the text of the reason.
    reason = F.lit(f"Null in: {list(cols)}")
    quarantine = (
        df.where(any_null(cols))
        .withColumn("_dq_reason", reason)
        .withColumn("_dq_null_cols", null_names)
    )
    return df.where(~any_null(cols)), quarantine


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ("event_id",),
    order_col: str = "_ingested_at",
    tie_cols: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row per key; equal times are decided by ``tie_cols``, else by a row hash.

    The rank filter becomes a group limit before the shuffle, so each task sends at most
    one copy of a key however many it holds.
    """
    ties = [F.col(c) for c in tie_cols] if tie_cols else [F.xxhash64(*df.columns)]
    latest = Window.partitionBy(*keys).orderBy(F.col(order_col).desc(), *ties)
    return (
        df.withColumn("_copy", F.row_number().over(latest)).where("_copy = 1").drop("_copy")
    )


def value_flags(df: DataFrame) -> DataFrame:
    """Adds ``_dq_flags``: names of the suspicious values, in a fixed order; '' if none."""
    # Limits, names and order of the flags.
    checks = [
        (F.col("latency_ms") < 0, "negative_latency,"),
        (~F.col("status_code").between(100, 599), "invalid_status,"),
        (F.col("latency_ms") > 60000, "extreme_latency,"),
    ]
    marks = [F.when(bad, F.lit(name)).otherwise(F.lit("")) for bad, name in checks]
    return df.withColumn("_dq_flags", F.concat(*marks))


def observe_quality(
    df: DataFrame, observation: Observation, cols: Sequence[str] = CRITICAL_COLS
) -> DataFrame:
    """The same rows; counts them while they are written, without a job of its own."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~any_null(cols)).alias("valid_rows"),
        F.count_if(any_null(cols)).alias("quarantined_rows"),
    )


def dq_summary(
    df: DataFrame, cols: Sequence[str] = CRITICAL_COLS, key: str = "event_id"
) -> DataFrame:
    """One row: input, valid and quarantined rows, and copies among the valid rows."""
    valid_key = F.when(~any_null(cols), F.col(key))
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~any_null(cols)).alias("valid_rows"),
        F.count_if(any_null(cols)).alias("quarantined_rows"),
        F.count_distinct(valid_key).alias("_keys"),
    )
    return counted.select(
        "total_rows",
        "valid_rows",
        "quarantined_rows",
        (F.col("valid_rows") - F.col("_keys")).alias("duplicates_removed"),
    )


def quality_by_file(df: DataFrame, cols: Sequence[str] = CRITICAL_COLS) -> DataFrame:
    """Input, valid and quarantined rows of each Bronze file among the rows."""
    bad = any_null(cols)
    return df.groupBy(DATE_COL, FILE_COL).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("quarantined_rows"),
    )


def quality_of_files(files: DataFrame, silver: DataFrame) -> DataFrame:
    """The row of :func:`dq_summary` for all files noted by :func:`quality_by_file`.

    A file noted several times counts once. Silver holds one row for each key, so the valid
    rows beyond its size are the copies: no key is counted anew.
    """
    kinds = ["total_rows", "valid_rows", "quarantined_rows"]
    noted = files.distinct().select(*kinds, F.col("valid_rows").alias("duplicates_removed"))
    none = [F.lit(0).cast("bigint").alias(kind) for kind in kinds]
    held = silver.agg(F.count(F.lit(1)).alias("_n")).select(*none, -F.col("_n"))
    return noted.union(held).agg(
        *[F.sum(kind).alias(kind) for kind in [*kinds, "duplicates_removed"]]
    )


def _uncastable(df: DataFrame, name: str, type_name: str) -> Column:
    source = F.col(f"`{name}`")
    try:
        df.select(source.try_cast(type_name))
    except AnalysisException:
        return F.count(source)
    return F.count_if(source.isNotNull() & source.try_cast(type_name).isNull())


def _field_list(df: DataFrame, schema: StructType, type_name: str) -> DataFrame:
    listed = [(f.name, f.dataType.simpleString()) for f in schema]
    return df.sparkSession.createDataFrame(listed, f"column string, {type_name} string")


def schema_drift(df: DataFrame, expected: StructType) -> DataFrame:
    """One row per drifted column, with its non-null values and those that fail the cast.

    The two field lists are joined by name; the drifted columns that are there are profiled
    in one aggregation over the data.
    """
    fields = _field_list(df, expected, "expected_type").join(
        _field_list(df, df.schema, "actual_type"), "column", "full_outer"
    )
    drift = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "extra")
        .when(F.col("actual_type") != F.col("expected_type"), "type")
    )
    expected_types = {f.name: f.dataType for f in expected}
    profiles = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count(F.col(f"`{f.name}`")).alias("non_null"),
            (
                _uncastable(df, f.name, expected_types[f.name].simpleString())
                if f.name in expected_types
                else F.lit(0).cast("bigint")
            ).alias("uncastable"),
        )
        for f in df.schema
        if expected_types.get(f.name) != f.dataType
    ]
    kind = "array<struct<column:string,non_null:bigint,uncastable:bigint>>"
    profile = df.agg(F.array(*profiles).cast(kind).alias("p")).select(F.inline("p"))
    drifted = fields.withColumn("drift", drift).where("drift IS NOT NULL")
    return drifted.join(profile, "column", "left").select(
        "column",
        "drift",
        "expected_type",
        "actual_type",
        F.coalesce("non_null", F.lit(0)).alias("non_null"),
        F.coalesce("uncastable", F.lit(0)).alias("uncastable"),
    )


def table_stats(df: DataFrame, label: str) -> DataFrame:
    """One row: label, row count and number of non-empty partitions."""
    per_partition = (
        df.select(F.spark_partition_id().alias("_part"))
        .groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return per_partition.agg(
        F.lit(label).alias("label"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("partitions"),
    )
