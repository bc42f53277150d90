"""Measured sizes: checked broadcasts, hot keys and the shared scratch folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 1_000


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoints an intermediate result in the shared folder and counts its rows."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_base(spark))
    kept = df.checkpoint(eager=True)
    return kept, kept.count()


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint if the result was measured to be small; else Spark joins by shuffle."""
    kept, rows = materialise(df)
    return F.broadcast(kept) if rows <= max_rows else kept


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than ``min_rows`` rows; at most ``rows / min_rows`` keys can be hot.

    A short list lies in ``values`` as literals; beyond ``literals`` they lie in
    ``table``, a checkpointed frame with the one column ``_hot``. With ``every``, all keys
    count as hot.
    """

    values: list
    every: bool = False
    table: DataFrame | None = None

    @property
    def none(self) -> bool:
        return not self.values and not self.every and self.table is None

    def split(self, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """The rows of the other keys, and those of the hot ones; null can be a hot key."""
        if self.table is not None:
            same = F.col(key).eqNullSafe(F.col("_hot"))
            return df.join(self.table, same, "left_anti"), df.join(self.table, same, "left_semi")
        hot = self._test(key)
        return df.where(~hot), df.where(hot)

    def _test(self, key: str) -> Column:
        if self.every:
            return F.lit(True)
        named = F.col(key).isin([v for v in self.values if v is not None])
        on_null = F.lit(None in self.values)
        return F.when(F.col(key).isNull(), on_null).otherwise(named)


def hot_keys(
    df: DataFrame, key: str, min_rows: int = HOT_ROWS, literals: int = MAX_HOT_KEYS
) -> HotKeys:
    """Finds hot keys by one pre-aggregated count over the key column alone.

    More than ``literals`` keys are counted once more into a table, which
    is broadcast if it was measured to be small and else joined by shuffle.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.where(F.col("_n") > min_rows).select(F.col(key).alias("_hot"))
    found = hot.limit(literals + 1).collect()
    if len(found) > literals:
        return HotKeys([], table=checked_broadcast(hot))
    return HotKeys([r[0] for r in found])
