"""Sessions from idle gaps, and session summaries.

A user's session ends when the gap between two events, in whole seconds, is strictly
longer than the timeout. Two plans give the same sessions:

* by user: one shuffle on the user and one ordered pass over its events;
* by slice, for hot users: time is cut into slices no longer than the timeout, so all
  events of a user in one slice belong to one session. Only the first and last second of
  each slice are chained per user, at most one row per slice whatever the event rate, and
  the events take their session from the slice.

``hot`` names the hot users. By default they are counted in the given frame; a count over
the stored rows behind it does as well, since any choice gives the same sessions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runnel.functions.columns import error_sum, minutes_between, now_or, rounded, whole_seconds
from runnel.plans.sizing import HotKeys, hot_keys
from runnel.schemas import SESSIONS_DDL, column_names

TIMEOUT_MINS = 30
DAY_SECONDS = 86_400

_WORK = ["_sec", "_carry", "_slice", "_lo", "_hi", "_new"]


def _chain(df: DataFrame, user: str, order: list[str], timeout_mins: float) -> DataFrame:
    """Numbers the sessions along each user's ordered spans ``_lo`` .. ``_hi``."""
    line = Window.partitionBy(user).orderBy(*order)
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    previous = F.lag("_hi").over(line)
    opens = previous.isNull() | ((F.col("_lo") - previous) / 60 > timeout_mins)
    timed = F.col("_lo").isNotNull()
    return (
        df.withColumn("_new", timed & opens)
        .withColumn("session_num", F.sum(F.col("_new").cast("int")).over(upto))
        .withColumn(
            "session_origin",
            F.max(F.when(F.col("_new"), F.coalesce("_carry", "_lo"))).over(upto),
        )
        .withColumn("session_num", F.when(timed, F.col("session_num")))
        .withColumn("session_origin", F.when(timed, F.col("session_origin")))
    )


def _by_user(rows: DataFrame, user: str, order: list[str], timeout_mins: float) -> DataFrame:
    spans = rows.withColumns({"_lo": F.col("_sec"), "_hi": F.col("_sec")})
    return _chain(spans, user, order, timeout_mins).drop(*_WORK)


def _by_slice(rows: DataFrame, user: str, timeout_mins: float) -> DataFrame:
    # Slices end at midnight, so that a taken-up session shares none with another date.
    width = max(1, min(int(timeout_mins * 60), DAY_SECONDS))
    day = F.floor(F.col("_sec") / DAY_SECONDS)
    within = F.floor((F.col("_sec") - day * DAY_SECONDS) / width)
    sliced = rows.withColumn("_slice", day * (DAY_SECONDS // width + 1) + within)
    spans = (
        sliced.where(F.col("_slice").isNotNull())
        .groupBy(user, "_slice")
        .agg(
            F.min("_sec").alias("_lo"),
            F.max("_sec").alias("_hi"),
            F.min("_carry").alias("_carry"),
        )
    )
    numbered = _chain(spans, user, ["_slice"], timeout_mins).select(
        F.col(user).alias("_span_user"),
        F.col("_slice").alias("_span"),
        "session_num",
        "session_origin",
    )
    match = F.col(user).eqNullSafe(F.col("_span_user")) & (F.col("_slice") == F.col("_span"))
    return sliced.join(numbered, match, "left").drop("_span_user", "_span", *_WORK)


def _branches(
    df: DataFrame,
    user_col: str,
    ts_col: str,
    id_col: str,
    timeout_mins: float,
    hot: HotKeys | None,
    carried: DataFrame | None = None,
) -> list[DataFrame]:
    """The numbered events as one frame per plan, so that each keeps its own partitioning."""
    rows = df.withColumns(
        {"_sec": whole_seconds(ts_col), "_carry": F.lit(None).cast("bigint")}
    )
    if carried is not None:
        rows = rows.unionByName(carried, allowMissingColumns=True)
    hot = hot or hot_keys(df, user_col)
    order = [ts_col, id_col]
    if hot.none:
        return [_by_user(rows, user_col, order, timeout_mins)]
    if hot.every:
        return [_by_slice(rows, user_col, timeout_mins)]
    few, many = hot.split(rows, user_col)
    return [
        _by_user(few, user_col, order, timeout_mins),
        _by_slice(many, user_col, timeout_mins),
    ]


def _named(df: DataFrame, user_col: str, number: str) -> DataFrame:
    name = F.concat_ws("_", F.col(user_col), F.col(number).cast("string"))
    return df.withColumn("derived_session_id", F.when(F.col(number).isNotNull(), name))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def sessionize(
    df: DataFrame,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    timeout_mins: float = TIMEOUT_MINS,
    id_col: str = "event_id",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Adds ``session_num``, counted from 1 per user, and ``derived_session_id``.

    Rows without a time stay, with null session columns.
    """
    parts = _branches(df, user_col, ts_col, id_col, timeout_mins, hot)
    return _named(_union(parts), user_col, "session_num").drop("session_origin")


def session_gaps(
    df: DataFrame,
    user_col: str = "user_id",
    ts_col: str = "event_timestamp",
    timeout_mins: float = TIMEOUT_MINS,
    id_col: str = "event_id",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Adds the user's previous event time, the gap in minutes and the new-session flag."""

    def by_user(rows: DataFrame) -> DataFrame:
        line = Window.partitionBy(user_col).orderBy(ts_col, id_col)
        return rows.withColumn("prev_ts", F.lag(ts_col).over(line))

    def by_instant(rows: DataFrame) -> DataFrame:
        # Events at one instant differ only in the first of them, so the instants are
        # chained: within a minute by a window, across minutes by the minute's last one.
        minute = F.floor(whole_seconds(ts_col) / 60)
        timed = rows.where(F.col(ts_col).isNotNull())
        in_minute = Window.partitionBy("_user", "_minute").orderBy("_ts")
        instants = (
            timed.groupBy(F.col(user_col).alias("_user"), F.col(ts_col).alias("_ts"))
            .agg(F.min(id_col).alias("_first"))
            .withColumn("_minute", F.floor(whole_seconds("_ts") / 60))
            .withColumn("_near", F.lag("_ts").over(in_minute))
        )
        minutes = (
            timed.groupBy(F.col(user_col).alias("_m_user"), minute.alias("_m"))
            .agg(F.max(ts_col).alias("_last"))
            .withColumn("_far", F.lag("_last").over(Window.partitionBy("_m_user").orderBy("_m")))
        )
        same_user = F.col("_user").eqNullSafe(F.col("_m_user"))
        same_minute = same_user & (F.col("_minute") == F.col("_m"))
        chained = instants.join(minutes, same_minute, "left").select(
            "_user", "_ts", "_first", F.coalesce("_near", "_far").alias("_before")
        )
        same_instant = F.col(user_col).eqNullSafe(F.col("_user")) & (F.col(ts_col) == F.col("_ts"))
        first = F.col(id_col) == F.col("_first")
        return (
            rows.join(chained, same_instant, "left")
            .withColumn("prev_ts", F.when(first, F.col("_before")).otherwise(F.col(ts_col)))
            .drop("_user", "_ts", "_first", "_before")
        )

    hot = hot or hot_keys(df, user_col)
    if hot.none:
        linked = by_user(df)
    elif hot.every:
        linked = by_instant(df)
    else:
        few, many = hot.split(df, user_col)
        linked = by_user(few).unionByName(by_instant(many))
    gap = minutes_between(F.col("prev_ts"), F.col(ts_col))
    return linked.withColumn("gap_mins", gap).withColumn(
        "is_new_session", F.col("prev_ts").isNull() | (F.col("gap_mins") > timeout_mins)
    )


def _measures(events: Column) -> list[Column]:
    start, end = F.min("event_timestamp"), F.max("event_timestamp")
    earliest = F.struct("event_timestamp", "event_id")
    return [
        start.alias("session_start"),
        end.alias("session_end"),
        events.alias("total_events"),
        rounded(minutes_between(start, end), 2).alias("session_duration_mins"),
        F.count_distinct("endpoint").alias("unique_endpoints"),
        error_sum().cast("bigint").alias("errors_in_session"),
        rounded(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        F.min_by("region", earliest).alias("region"),
    ]


def _summary(
    df: DataFrame, session: str, events: Column, computed_at: Column | None
) -> DataFrame:
    return (
        df.groupBy("user_id", session, "event_date")
        .agg(*_measures(events))
        .withColumn("_computed_at", now_or(computed_at))
    )


def session_summary(sessionized: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """One row per session and date; the region is that of the earliest event."""
    named = sessionized.where(F.col("derived_session_id").isNotNull())
    rows = _summary(named, "derived_session_id", F.count("event_id"), computed_at)
    return rows.select(*column_names(SESSIONS_DDL))


def _numbered_summary(
    parts: list[DataFrame], number: str, computed_at: Column | None
) -> DataFrame:
    """Each part is aggregated on its own partitioning, by number, and named afterwards."""
    rows = [
        _summary(p.where(F.col(number).isNotNull()), number, F.count("event_id"), computed_at)
        for p in parts
    ]
    return _named(_union(rows), "user_id", number).select(*column_names(SESSIONS_DDL))


def idle_sessions(
    silver: DataFrame,
    computed_at: Column | None = None,
    timeout_mins: float = TIMEOUT_MINS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Summary of the idle-gap sessions."""
    parts = _branches(silver, "user_id", "event_timestamp", "event_id", timeout_mins, hot)
    return _numbered_summary(parts, "session_num", computed_at)


def session_summary_client(silver: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """Summary of the sessions named by the client, per user, session id and date."""
    names = column_names(SESSIONS_DDL)
    name = F.concat("user_id", F.lit("_"), "session_id")
    return (
        _summary(silver, "session_id", F.count(F.lit(1)), computed_at)
        .withColumn("derived_session_id", name)
        .select(*names[:2], "session_id", *names[2:])
    )


def _origin(session_id: Column | str) -> Column:
    """The first second of a session, from its id."""
    return F.substring_index(session_id, "_", -1).try_cast("bigint")


def open_sessions(previous_day: DataFrame) -> DataFrame:
    """Each user's last session of a date, as the starting point of the next date's chain."""
    last = F.max_by(
        F.struct("derived_session_id", "session_end"), F.struct("session_end", "derived_session_id")
    )
    return (
        previous_day.groupBy("user_id", "event_date")
        .agg(last.alias("_last"))
        .select(
            "user_id",
            whole_seconds("_last.session_end").alias("_sec"),
            _origin("_last.derived_session_id").alias("_carry"),
            F.col("_last.session_end").alias("event_timestamp"),
        )
    )


def resumable_sessions(
    silver: DataFrame,
    previous_day: DataFrame | None = None,
    computed_at: Column | None = None,
    timeout_mins: float = TIMEOUT_MINS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Summary with ids that stay the same between runs: user and first second of the session.

    ``silver`` holds whole dates; ``previous_day`` the summary of the date before them, or of
    the date before each run of adjoining ones. As the timeout is shorter than a day, a
    session running into a date has a row on the previous one, so no older events need to be
    read, and runs with a date between them do not touch.
    """
    carried = open_sessions(previous_day) if previous_day is not None else None
    parts = _branches(
        silver, "user_id", "event_timestamp", "event_id", timeout_mins, hot, carried
    )
    events = [p.where(F.col("event_id").isNotNull()) for p in parts]
    return _numbered_summary(events, "session_origin", computed_at)


def stale_users(
    summary: DataFrame, dates: Sequence[dt.date], timeout_mins: float = TIMEOUT_MINS
) -> DataFrame:
    """Users and dates of a resumable summary that do not fit the date before them.

    ``summary`` holds the given dates and those before each. A user's first session of a
    date must carry the id of its last one of the date before if that one was still open,
    else an id of its own. One row per user and date is compared.
    """
    days = summary.groupBy("user_id", "event_date").agg(
        F.min("session_start").alias("_start"),
        F.max("session_end").alias("_end"),
        F.min_by("derived_session_id", "session_start").alias("_first"),
        F.max_by("derived_session_id", "session_end").alias("_last"),
    )
    line = Window.partitionBy("user_id").orderBy("event_date")
    adjoins = F.lag("event_date").over(line) == F.date_sub("event_date", 1)
    near = minutes_between(F.lag("_end").over(line), F.col("_start")) <= timeout_mins
    carried = F.when(adjoins & near, _origin(F.lag("_last").over(line)))
    due = F.coalesce(carried, whole_seconds("_start"))
    judged = days.withColumn("_fits", _origin("_first").eqNullSafe(due))
    stale = judged.where(F.col("event_date").isin(list(dates)) & ~F.col("_fits"))
    return stale.select("user_id", "event_date")
