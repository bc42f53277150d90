"""Exact interpolated percentiles per group, without collecting a group anywhere.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here
the values are first counted in ordered buckets, a few thousand per group. The counts say
exactly which bucket holds each wanted rank; only the rows of those buckets, about a
thousandth of the data, are then counted by value. Should many values crowd into one
bucket, equal steps between its ends narrow it down once more before values are ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.functions.columns import same_row
from runnel.plans.sizing import BROADCAST_ROWS, checked_broadcast

BUCKETS_PER_E_FOLD = 1024
FINER_STEPS = 1024


def ordered_bucket(value: Column) -> Column:
    """A whole number that never falls as the value rises; about 0.1 % wide.

    Any non-decreasing function is right here; its steps only decide how evenly the
    rows spread.
    """
    # NaN is the largest number, as in Spark's own order.
    finite = F.floor(F.signum(value) * F.log1p(F.abs(value)) * BUCKETS_PER_E_FOLD)
    return F.when(F.isnan(value), F.lit(2**63 - 1)).otherwise(finite)


def finer_bucket(value: Column, low: Column, high: Column) -> Column:
    """The place of a value between the ends of its bucket, in ``FINER_STEPS`` equal steps."""
    step = F.floor((value - low) / (high - low) * FINER_STEPS)
    return F.when(low == high, F.lit(0).cast("bigint")).otherwise(step)


def _ranks(total: Column, p: float) -> tuple[Column, Column, Column]:
    position = (total - 1) * F.lit(float(p))
    return position, F.floor(position), F.ceil(position)


def _holding(counted: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """The rows whose span ``_before`` .. ``_before + _n`` holds a wanted rank."""
    wanted = F.lit(False)
    for p in probs.values():
        _, low, high = _ranks(F.col("_total"), p)
        for rank in (low, high):
            inside = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))
            wanted = wanted | inside
    return counted.where(wanted)


def _rows_before(group: Sequence[str], order: str) -> Column:
    """The number of rows of the group in front of a bucket or value."""
    line = Window.partitionBy(*group).orderBy(order)
    return F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``keys`` and one interpolated percentile per entry of ``probs``; nulls are ignored."""
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_value")
    )
    rows = rows.withColumn("_bucket", ordered_bucket(F.col("_value")))
    buckets = (
        rows.groupBy(*keys, "_bucket")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_value").alias("_low"),
            F.max("_value").alias("_high"),
        )
        .withColumn("_before", _rows_before(keys, "_bucket"))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    )
    # What is known of a bucket, and travels with its values.
    known = ["_before", "_total", "_low", "_high"]
    targets = _holding(buckets, probs).select(*keys, "_bucket", *known)
    targets = checked_broadcast(targets, broadcast_rows)

    group = [*keys, "_bucket"]
    values = (
        rows.alias("r")
        .join(targets.alias("t"), same_row(group, "r", "t"))
        .select("r.*", *[f"t.{c}" for c in known])
        .groupBy(*group, *known, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_fine", finer_bucket(F.col("_value"), F.col("_low"), F.col("_high")))
    )
    fine = (
        values.groupBy(*group, "_before", "_total", "_fine")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_before", F.col("_before") + _rows_before(group, "_fine"))
    )
    fine = _holding(fine, probs).select(*group, "_fine", "_before", "_total")
    cell = [*group, "_fine"]
    ranked = (
        values.alias("v")
        .join(fine.alias("f"), same_row(cell, "v", "f"))
        .select(*[f"v.{c}" for c in [*cell, "_value", "_n"]], "f._before", "f._total")
        .withColumn("_before", F.col("_before") + _rows_before(cell, "_value"))
    )

    def at(rank: Column) -> Column:
        hit = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))
        return F.max(F.when(hit, F.col("_value")))

    picks, results = [F.max("_total").alias("_total")], []
    for name, p in probs.items():
        position, low, high = _ranks(F.col("_total"), p)
        picks += [at(low).alias(f"_{name}_low"), at(high).alias(f"_{name}_high")]
        below, above = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        between = below + (above - below) * (position - low)
        results.append(F.when(below == above, below).otherwise(between).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *results)
