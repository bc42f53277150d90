"""Slowly changing dimension history: versions with a validity interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.functions.columns import differs, row_checksum

AUDIT_COLS = ["effective_start_date", "effective_end_date", "is_current", "_checksum"]


def scd2_stage(df: DataFrame, compare_cols: Sequence[str], at: Column) -> DataFrame:
    """A snapshot as current versions with an open end; also the first load of a history."""
    return df.withColumns(
        {
            "effective_start_date": at,
            "effective_end_date": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
            "_checksum": row_checksum(compare_cols),
        }
    )


def current_rows(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def _changed(compare_cols: Sequence[str], old: str, new: str) -> Column:
    cond = F.lit(False)
    for c in compare_cols:
        cond = cond | differs(F.col(f"{old}.{c}"), F.col(f"{new}.{c}"))
    return cond


def _closed(names: Sequence[str], alias: str, when: Column, at: Column) -> list[Column]:
    """The columns of a version, closed at ``at`` where ``when`` holds."""
    over = {
        "effective_end_date": F.when(when, at).otherwise(F.col(f"{alias}.effective_end_date")),
        "is_current": F.col(f"{alias}.is_current") & ~when,
    }
    return [over.get(c, F.col(f"{alias}.{c}")).alias(c) for c in names]


def scd2_expire(
    history: DataFrame, new: DataFrame, key: str, compare_cols: Sequence[str], at: Column
) -> DataFrame:
    """The history with the current rows closed whose compared values changed."""
    source = new.select(key, *compare_cols, F.lit(True).alias("_in"))
    match = F.col("h.is_current") & (F.col(f"h.{key}") == F.col(f"n.{key}"))
    changed = F.col("n._in").isNotNull() & _changed(compare_cols, "h", "n")
    return (
        history.alias("h")
        .join(source.alias("n"), match, "left")
        .select(*_closed(history.columns, "h", changed, at))
    )


def scd2_new_rows(history: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Staged rows that no current row equals in key and checksum."""
    current = current_rows(history).select(key, "_checksum")
    return staged.join(current, [key, "_checksum"], "left_anti").select(*staged.columns)


def scd2_apply(
    history: DataFrame,
    new: DataFrame,
    key: str,
    compare_cols: Sequence[str],
    at: Column,
    given_col: str | None = None,
) -> DataFrame:
    """The history after loading a snapshot with one row per key.

    One full outer join of the current versions with the snapshot yields, per key, the old
    version (closed if changed) and the new one; closed versions are not shuffled. Keys
    missing from the snapshot stay current. ``given_col`` names a further column that tells
    whether the snapshot has the key; for versions closed before it is null.
    """
    staged = scd2_stage(new, compare_cols, at).withColumn("_in", F.lit(True))
    current = current_rows(history).withColumn("_was", F.lit(True))
    names = history.columns
    joined = current.alias("h").join(
        staged.alias("n"), F.col(f"h.{key}") == F.col(f"n.{key}"), "full_outer"
    )
    was, given = F.col("h._was").isNotNull(), F.col("n._in").isNotNull()
    changed = was & given & _changed(compare_cols, "h", "n")
    old = F.struct(*_closed(names, "h", changed, at))
    fresh = F.struct(*[F.col(f"n.{c}").alias(c) for c in names])
    versions = F.array_compact(F.array(F.when(was, old), F.when(given & (~was | changed), fresh)))
    closed = history.where("NOT is_current")
    if given_col is None:
        return closed.unionByName(joined.select(F.inline(versions)))
    marked = joined.select(F.inline(versions), given.alias(given_col))
    return closed.unionByName(marked, allowMissingColumns=True)


def scd2_splice(
    history: DataFrame,
    new: DataFrame,
    key: str,
    compare_cols: Sequence[str],
    at: Column,
    later: Column,
    missed: DataFrame,
) -> DataFrame:
    """The history as if a snapshot that comes late had been loaded at its time.

    ``history`` has the versions that end after ``at``, or all of them. A key's value counts
    from ``at`` up to the first later load whose snapshot had the key; there the stored value
    takes over again, as a version of its own or, if it is the same, by extending that
    version back to ``at``. ``later`` is the array of the later loads' times, ``missed`` has
    a row ``key, at`` for each load without that key. One full outer join with the snapshot
    and one ordered pass over each key's versions, which are at most as many as the loads.

    Three columns are added: ``_given`` (the snapshot has the key), ``_since`` (the start
    before the splice, null for new rows) and ``_moved`` (the row is new or has changed).
    Where two snapshots agree in the compared columns, the others come from the stored one.
    """
    names = history.columns
    gone = missed.where(F.col("at") > at).groupBy(F.col(key).alias("_k"))
    gone = gone.agg(F.collect_set("at").alias("_gone"))
    staged = scd2_stage(new, compare_cols, at).withColumn("_in", F.lit(True))
    staged = staged.join(gone, F.col(key) == F.col("_k"), "left").drop("_k")
    staged = staged.withColumn("_later", later)
    known = history.withColumn("_was", F.lit(True))
    joined = known.alias("h").join(
        staged.alias("n"), F.col(f"h.{key}") == F.col(f"n.{key}"), "full_outer"
    )
    absent = F.coalesce("_gone", F.array().cast("array<timestamp_ntz>"))
    returns = F.array_min(F.filter("_later", lambda x: ~F.array_contains(absent, x)))
    start, end = F.col("h.effective_start_date"), F.col("h.effective_end_date")
    line = Window.partitionBy(F.coalesce(f"h.{key}", f"n.{key}")).orderBy(start)
    given = F.coalesce("_in", F.lit(False))
    marked = joined.select(
        F.when(F.col("_was"), F.struct(*[F.col(f"h.{c}").alias(c) for c in names])).alias("old"),
        F.struct(*[F.col(f"n.{c}").alias(c) for c in names]).alias("row"),
        given.alias("_given"),
        start.alias("_since"),
        end.alias("_until"),
        F.coalesce(start <= at, F.lit(False)).alias("_valid"),
        (given & ~_changed(compare_cols, "h", "n")).alias("_same"),
        returns.alias("_returns"),
        F.lag(start <= at).over(line).alias("_after_valid"),
        F.lag(~_changed(compare_cols, "h", "n")).over(line).alias("_before_same"),
        F.lag("_was").over(line).isNull().alias("_first"),
        F.lead(~_changed(compare_cols, "h", "n")).over(line).alias("_next_same"),
    )

    def version(of: str, begin: Column, stop: Column, moved: bool) -> Column:
        over = {
            "effective_start_date": begin,
            "effective_end_date": stop,
            "is_current": stop.isNull(),
        }
        fields = [over.get(c, F.col(f"{of}.{c}")).alias(c) for c in names]
        return F.struct(
            *fields,
            F.col("_given").alias("_given"),
            F.col("_since").alias("_since"),
            F.lit(moved).alias("_moved"),
        )

    since, until, back = F.col("_since"), F.col("_until"), F.col("_returns")
    never = F.lit(None).cast("timestamp_ntz")
    kept = F.array(version("old", since, until, False))
    # The version valid at the time, with another value than the snapshot.
    resumed = back.isNotNull() & (until.isNull() | (back < until))
    joins_next = back.eqNullSafe(until) & F.coalesce("_next_same", F.lit(False)) & until.isNotNull()
    cut = F.array(
        version("old", since, at, True),
        F.when(~joins_next, version("row", at, back, True)),
        F.when(resumed, version("old", back, until, True)),
    )
    # The version after it; without one before, the key is new to the history at that time.
    follows = ~F.col("_valid") & (F.col("_first") | F.col("_after_valid"))
    extends = (
        follows
        & F.col("_same")
        & (F.col("_first") | (~F.col("_before_same") & (back == since)))
    )
    starts = F.array(version("row", at, since, True), version("old", since, until, False))
    versions = (
        F.when(F.col("old").isNull(), F.array(version("row", at, never, True)))
        .when(~F.col("_given"), kept)
        .when(F.col("_valid") & ~F.col("_same"), cut)
        .when(extends, F.array(version("row", at, until, True)))
        .when(follows & F.col("_first"), starts)
        .otherwise(kept)
    )
    return marked.select(F.inline(F.array_compact(versions)))


def history_as_of(
    history: DataFrame, ts: Column | None = None, version: int | None = None
) -> DataFrame:
    """The versions valid at a time, or after the n-th load (from 0) that changed anything."""
    if version is not None:
        loads = history.select(
            F.explode(F.array("effective_start_date", "effective_end_date")).alias("_at")
        )
        moments = loads.where("_at IS NOT NULL").distinct().orderBy("_at")
        ts = moments.offset(version).limit(1).scalar()
    elif ts is None:
        raise ValueError("an as-of read needs a time or a version number")
    end = F.col("effective_end_date")
    return history.where((F.col("effective_start_date") <= ts) & (end.isNull() | (ts < end)))


def history_prune(history: DataFrame, as_of: Column, hours: int = 168) -> DataFrame:
    """Drops versions closed more than ``hours`` before ``as_of``."""
    limit = as_of - F.make_dt_interval(hours=F.lit(hours))
    return history.where(F.col("is_current") | (F.col("effective_end_date") >= limit))
