"""Upserts and evolving appends between frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from runnel.functions.columns import same_row


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, and the target rows whose key is not in the source (keys unique there).

    A column that one side lacks is null in its rows.
    """
    kept = target.alias("t").join(
        source.select(*keys).alias("s"), same_row(keys, "t", "s"), "left_anti"
    )
    return kept.unionByName(source, allowMissingColumns=True)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fails if two rows share a key, as it would not be clear which of them counts."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"several rows for one key: {twice[0].asDict()}")


def append_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return old.unionByName(new, allowMissingColumns=True)
