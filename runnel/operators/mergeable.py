"""Gold cells that can be merged: exact distinct counts as bitmaps, percentiles as sketches.

A number of distinct users cannot be added up over cells, and a percentile cannot be averaged.
A bitmap of numbered users can be united, and a quantile sketch merged, so reports over any
group of cells read Gold alone. Bitmaps are exact; a sketch has a stated error of rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runnel.schemas import KPI_KEYS

#: Keys are numbered within so many hash buckets, each by a window of its own.
NUMBER_BUCKETS = 1_024
#: Size of a sketch: the rank of a merged percentile is off by at most RANK_ERROR.
SKETCH_SIZE, RANK_ERROR = 2_000, 0.005

NUMBERS_DDL = "key STRING, number BIGINT, kind STRING"
BITMAPS_DDL = (
    "event_date DATE, service STRING, region STRING, kind STRING, bucket BIGINT, bits BINARY"
)
SKETCHES_DDL = "event_date DATE, service STRING, region STRING, sketch BINARY"


def new_numbers(keys: DataFrame, known: DataFrame) -> DataFrame:
    """Numbers for the values of the one column of ``keys`` that ``known`` does not have.

    Each hash bucket goes on behind its own largest number, so numbers stay dense, no window
    runs over all keys, and numbers once given never change.
    """
    fresh = keys.toDF("key").where("key IS NOT NULL").distinct().join(known, "key", "left_anti")
    slot = F.pmod(F.xxhash64("key"), F.lit(NUMBER_BUCKETS))
    held = known.groupBy(F.pmod("number", F.lit(NUMBER_BUCKETS)).alias("_slot")).agg(
        F.count(F.lit(1)).alias("_held")
    )
    place = F.row_number().over(Window.partitionBy("_slot").orderBy("key")) - 1
    ranked = fresh.withColumn("_slot", slot).withColumn("_place", place)
    after = F.col("_place") + F.coalesce("_held", F.lit(0))
    return ranked.join(held, "_slot", "left").select(
        "key", (after * NUMBER_BUCKETS + F.col("_slot")).alias("number")
    )


def cell_bitmaps(silver: DataFrame, key: str, numbers: DataFrame) -> DataFrame:
    """One row for each cell and range of 32,768 numbers: the bits of the keys in the cell.

    Copies of a key within a cell are merged before anything is shuffled for the join.
    """
    found = silver.where(F.col(key).isNotNull()).select(*KPI_KEYS, F.col(key).alias("key")).distinct()
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number"))
    return (
        found.join(numbers.select("key", "number"), "key")
        .groupBy(*KPI_KEYS, F.bitmap_bucket_number("number").alias("bucket"))
        .agg(bits.alias("bits"))
    )


def distinct_counts(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, kind, n``: different keys of all cells of a group, each counted once."""
    united = bitmaps.groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by, "kind").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def cell_sketches(silver: DataFrame) -> DataFrame:
    """One quantile sketch of the latencies for each cell."""
    sketch = F.kll_sketch_agg_double("latency_ms", SKETCH_SIZE)
    return silver.groupBy(*KPI_KEYS).agg(sketch.alias("sketch"))


def merged_percentiles(
    sketches: DataFrame, by: Sequence[str], probs: dict[str, float]
) -> DataFrame:
    """``by``, the number of values and their percentiles over all cells of a group."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("_s"))
    size = F.kll_sketch_get_n_double("_s")
    at = [
        F.when(size > 0, F.kll_sketch_get_quantile_double("_s", F.lit(p))).alias(name)
        for name, p in probs.items()
    ]
    return merged.select(*by, size.alias("n"), *at)
