"""The table flow: raw files to Bronze, Silver and Gold, as separate re-runnable stages."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runnel.functions.columns import now_or
from runnel.operators.gold import KPI_INPUTS, daily_kpis
from runnel.operators.layout import cache_if_reused, compact
from runnel.operators.mergeable import NUMBERS_DDL, cell_bitmaps, cell_sketches, new_numbers
from runnel.operators.quality import observe_quality, split_nulls
from runnel.operators.sessions import (
    resumable_sessions,
    session_summary_client,
    stale_users,
)
from runnel.operators.silver import (
    clean,
    incremental,
    to_bronze,
    to_silver_sql,
)
from runnel.plans.sizing import materialise
from runnel.schemas import (
    CRITICAL_COLS,
    DAILY_KPIS_DDL,
    DATE_COL,
    KPI_KEYS,
    LOAD_COL,
    SESSIONS_DDL,
    SILVER_DDL,
    STORED_DDL,
)
from runnel.sources.keyindex import copies_of, keys_of_load, read_load, silver_date, strays
from runnel.sources.raw import read_raw_lines
from runnel.sources.tables import (
    append_bronze,
    create_tables,
    date_values,
    delete_folders,
    first_file,
    publish_dates,
    publish_tables,
    read_dates,
    read_dates_of,
    read_table,
    replace_dates,
    table_exists,
    write_table,
)

DAY = dt.timedelta(days=1)
#: Folder inside Silver with the dates that lost all their rows; readers pass over it.
EMPTIED = "_emptied"
#: Folder inside the session summary with the dates that a refresh has still to do.
PENDING = "_pending"
NOTE_DDL = f"{DATE_COL} DATE"


@dataclass(frozen=True)
class Tables:
    """Paths of the tables below one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/raw_logs"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/logs_cleaned"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine/silver"

    @property
    def daily_kpis(self) -> str:
        return f"{self.root}/gold/daily_kpis"

    @property
    def sessions(self) -> str:
        return f"{self.root}/gold/session_summary"

    @property
    def numbers(self) -> str:
        return f"{self.root}/gold/key_numbers"

    @property
    def bitmaps(self) -> str:
        return f"{self.root}/gold/active_bitmaps"

    @property
    def sketches(self) -> str:
        return f"{self.root}/gold/latency_sketches"


def load_bronze(
    spark: SparkSession,
    raw: str,
    tables: Tables,
    ingested_at: Column | None = None,
    load: str | None = None,
) -> str:
    """Appends raw files, and gives the name of the load. Pass only new files, or use the
    stream.

    A load that broke off can be repeated under its name ``load`` without adding copies.
    Fields that the data model lacks are kept, see ``unknown_fields``.
    """
    load = load or uuid.uuid4().hex
    raw_logs = read_raw_lines(spark, raw).withColumn("_ingested_at", now_or(ingested_at))
    append_bronze(to_bronze(raw_logs), tables.bronze, load)
    return load


def _in_dates(day: Column, dates: Iterable[dt.date | None]) -> Column:
    dates = list(dates)
    named = day.isNotNull() & day.isin([d for d in dates if d is not None])
    # Never null, so that its negation holds for rows without a date.
    return named | (day.isNull() & F.lit(None in dates))


def _all_dates(*frames: DataFrame) -> DataFrame:
    """All dates of the frames' date columns, as one column."""
    parts = [
        f.select(F.explode(F.array([c for c, kind in f.dtypes if kind == "date"])).alias(DATE_COL))
        for f in frames
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def touched_dates(spark: SparkSession, bronze: str, load: str) -> list[dt.date | None] | None:
    """All dates, in Bronze and in Silver, of a load's rows and of older copies of them.

    Only the load itself and the index are read. None if they are more than ``MAX_DATES``.
    """
    mine = keys_of_load(spark, bronze, load)
    arrived = read_load(spark, bronze, load).select(DATE_COL)
    return date_values(_all_dates(arrived, mine, copies_of(spark, bronze, mine)))


def _stored_on(
    spark: SparkSession, bronze: str, places: DataFrame, dates: Sequence[dt.date | None] = ()
) -> DataFrame | None:
    """The Bronze rows of the dates that occur in ``places``, and of ``dates``; None without any."""
    found = date_values(places)
    if found is None:
        named = spark.createDataFrame([(d,) for d in dates], NOTE_DDL)
        rows = read_dates_of(spark, bronze, named.unionByName(places), STORED_DDL)
    elif found or dates:
        rows = read_dates(spark, bronze, [*dates, *found], STORED_DDL)
    else:
        return None
    return first_file(rows).drop(LOAD_COL)


def bronze_for(
    spark: SparkSession, bronze: str, dates: Sequence[dt.date | None]
) -> tuple[DataFrame, DataFrame]:
    """The Bronze rows that some Silver dates follow from: those of these dates, and their
    copies on other dates; and the Bronze rows of the same dates.

    The index says on which dates rows of either kind lie, so only these are read; without
    copies on other dates there is nothing to look for.
    """
    moved = strays(spark, bronze)
    inside = _in_dates(F.col("silver_date"), dates) | _in_dates(F.col("bronze_date"), dates)
    ids = moved.where(inside).select("event_id").distinct()
    places = moved.join(ids, "event_id", "left_semi").withColumn(DATE_COL, F.col("bronze_date"))
    belongs = _in_dates(F.col("silver_date"), dates)
    rows = _stored_on(spark, bronze, places.where(belongs).select(DATE_COL), dates)
    far = _stored_on(spark, bronze, places.where(~belongs).select(DATE_COL))
    own = rows.where(_in_dates(F.col(DATE_COL), dates))
    here = _in_dates(silver_date(), dates)
    needed = rows.where(here)
    if far is not None:
        needed = needed.unionByName(far.where(~here).join(ids, "event_id", "left_semi"))
    return needed, own


def replace_silver(
    df: DataFrame, silver: str, dates: Sequence[dt.date | None] | DataFrame
) -> None:
    """Replaces dates of Silver, and notes the emptied ones for those who follow its files."""
    emptied = replace_dates(df, silver, dates)
    note = [(d,) for d in emptied if d is not None]
    if note:
        noted = df.sparkSession.createDataFrame(note, NOTE_DDL).coalesce(1)
        noted.write.mode("append").parquet(f"{silver}/{EMPTIED}")


def refresh_silver(
    spark: SparkSession, tables: Tables, dates: Iterable[dt.date | None] | None = None
) -> dict[str, int]:
    """Cleans all of Bronze, or some dates of Silver (None: the rows without a date).

    Whole dates are replaced, so a repeated run does not add copies, and a date whose rows
    have all moved is emptied. The copies of an event are looked for on all dates, by the
    index of ids; other dates of Bronze are not read.

    Gives the counts of the Bronze rows that were read for Silver, observed while it is
    written: all, valid and quarantined rows and the copies among the valid ones.
    """
    read, written = Observation(), Observation()
    kept = F.count(F.lit(1)).alias("kept")
    if dates is None:
        bronze = read_table(spark, tables.bronze, STORED_DDL)
        named = first_file(bronze)
        write_table(split_nulls(named, CRITICAL_COLS)[1], tables.quarantine, "overwrite")
        silver, _ = clean(observe_quality(bronze, read))
        write_table(silver.observe(written, kept), tables.silver, "overwrite")
        return _counts(read, written)
    dates = list(dates)
    rows, own = bronze_for(spark, tables.bronze, dates)
    silver, _ = clean(observe_quality(rows, read))
    silver = silver.observe(written, kept).where(_in_dates(F.col(DATE_COL), dates))
    replace_silver(silver, tables.silver, dates)
    replace_dates(split_nulls(own, CRITICAL_COLS)[1], tables.quarantine, dates)
    return _counts(read, written)


def _counts(read: Observation, written: Observation) -> dict[str, int]:
    counts = dict(read.get)
    return {**counts, "duplicates_removed": counts["valid_rows"] - written.get["kept"]}


def session_rows_before(spark: SparkSession, path: str, first: dt.date) -> DataFrame:
    """The session summary of the date before ``first``; no rows if there is none."""
    return read_dates(spark, path, [first - DAY], SESSIONS_DDL)


def _note(spark: SparkSession, sessions: str, dates: Sequence[dt.date]) -> None:
    noted = spark.createDataFrame([(d,) for d in dates], NOTE_DDL).coalesce(1)
    noted.write.mode("append").parquet(f"{sessions}/{PENDING}")


def _noted(spark: SparkSession, sessions: str) -> set[dt.date]:
    path = f"{sessions}/{PENDING}"
    if not table_exists(spark, path):
        return set()
    return {r[0] for r in read_table(spark, path, NOTE_DDL).distinct().collect()}


def refresh_sessions(
    spark: SparkSession,
    silver: str,
    sessions: str,
    dates: Iterable[dt.date],
    computed_at: Column | None = None,
) -> list[dt.date]:
    """Recomputes the sessions of the given dates, and of later ones for the users whose
    sessions change.

    A date depends on its events and on the sessions open at its first midnight, so only the
    date behind a recomputed one can change, and there only users whose first session no
    longer fits. All dates of a step are computed together. What a step has still to do is
    noted first, so a run that broke off is completed by repeating it. Gives the recomputed
    dates.
    """
    todo = sorted(set(dates) | _noted(spark, sessions))
    done: list[dt.date] = []
    users: DataFrame | None = None
    while todo:
        _note(spark, sessions, todo)
        whole = set(todo)
        first = [d - DAY for d in todo if d - DAY not in whole]
        events = read_dates(spark, silver, todo, SILVER_DDL)
        before = read_dates(spark, sessions, first, SESSIONS_DDL)
        if users is None:
            made = resumable_sessions(events, before, computed_at)
        else:
            at = ["user_id", DATE_COL]
            met = events.join(users, at, "left_semi")
            open_then = before.join(
                users.select("user_id", F.date_sub(DATE_COL, 1).alias(DATE_COL)), at, "left_semi"
            )
            others = read_dates(spark, sessions, todo, SESSIONS_DDL).join(users, at, "left_anti")
            fresh = resumable_sessions(met, open_then, computed_at)
            made = others.unionByName(fresh)
        replace_dates(made, sessions, todo)
        done += todo
        behind = sorted({d + DAY for d in todo} - whole)
        pairs = read_dates(spark, sessions, [*behind, *(d - DAY for d in behind)], SESSIONS_DDL)
        users, _ = materialise(stale_users(pairs, behind))
        todo = sorted(r[0] for r in users.select(DATE_COL).distinct().collect())
    delete_folders(spark, [f"{sessions}/{PENDING}"])
    return sorted(done)


def refresh_gold_dates(
    spark: SparkSession,
    silver: str,
    kpis: str,
    sessions: str,
    dates: Iterable[dt.date],
    computed_at: Column | None = None,
    exact: bool = False,
) -> list[dt.date]:
    """Recomputes both Gold tables for some dates of Silver; those without rows are emptied.
    Gives these and the later dates whose sessions followed.

    The columns that the indicators need are cached meanwhile, as several aggregations read
    them.
    """
    days = sorted(set(dates))
    if not days:
        return []
    needed = [*KPI_KEYS, *KPI_INPUTS]
    rows = cache_if_reused(read_dates(spark, silver, days, SILVER_DDL).select(*needed))
    try:
        replace_dates(daily_kpis(rows, computed_at, exact), kpis, days)
    finally:
        rows.unpersist()
    return refresh_sessions(spark, silver, sessions, days, computed_at)


def refresh_gold(
    spark: SparkSession,
    tables: Tables,
    dates: Iterable[dt.date | None] | None = None,
    computed_at: Column | None = None,
    exact: bool = False,
) -> list[dt.date]:
    """Recomputes both Gold tables for all dates, or for some and what follows from them.
    Gives the recomputed dates, if not all."""
    if dates is None:
        silver = read_table(spark, tables.silver, SILVER_DDL).where("event_date IS NOT NULL")
        write_table(daily_kpis(silver, computed_at, exact), tables.daily_kpis, "overwrite")
        whole = resumable_sessions(silver, None, computed_at)
        write_table(whole, tables.sessions, "overwrite")
        return []
    days = [d for d in dates if d is not None]
    return refresh_gold_dates(
        spark, tables.silver, tables.daily_kpis, tables.sessions, days, computed_at, exact
    )


#: What is counted exactly over any group of cells: its kind, and its Silver column.
COUNTED = {"user": "user_id", "session": "session_id"}


def refresh_mergeable(
    spark: SparkSession, tables: Tables, dates: Iterable[dt.date | None] | None = None
) -> None:
    """Recomputes the mergeable Gold tables from Silver, for all dates or for some.

    Keys met for the first time are numbered first; a repeated run finds them numbered.
    """
    silver = read_table(spark, tables.silver, SILVER_DDL).where("event_date IS NOT NULL")
    days = None
    if dates is not None:
        days = sorted({d for d in dates if d is not None})
        silver = read_dates(spark, tables.silver, days, SILVER_DDL)
    if not table_exists(spark, tables.numbers):
        write_table(spark.createDataFrame([], NUMBERS_DDL), tables.numbers, partition_cols=())
    parts = []
    for kind, column in COUNTED.items():
        known = read_table(spark, tables.numbers, NUMBERS_DDL).where(F.col("kind") == kind)
        fresh = new_numbers(silver.select(column), known.drop("kind"))
        write_table(fresh.withColumn("kind", F.lit(kind)), tables.numbers, partition_cols=())
        numbers = read_table(spark, tables.numbers, NUMBERS_DDL).where(F.col("kind") == kind)
        parts.append(cell_bitmaps(silver, column, numbers).withColumn("kind", F.lit(kind)))
    made = [(reduce(DataFrame.unionByName, parts), tables.bitmaps), (cell_sketches(silver), tables.sketches)]
    for df, path in made:
        if days is None:
            write_table(df, path, "overwrite")
        else:
            replace_dates(df, path, days)


def rebuild_from_view(
    spark: SparkSession, view: str, tables: Tables, at: Column | None = None
) -> None:
    """The SQL-only variant: every table is rebuilt from a view of the raw files.

    Casts instead of cleaning, exact percentiles, and sessions named by the client.
    """
    write_table(to_silver_sql(spark.table(view), at), tables.silver, "overwrite")
    silver = read_table(spark, tables.silver)
    write_table(daily_kpis(silver, at, exact=True), tables.daily_kpis, "overwrite")
    write_table(session_summary_client(silver, at), tables.sessions, "overwrite")


def compact_gold(
    spark: SparkSession, tables: Tables, as_of: dt.date, days: int = 1, files: int | None = None
) -> None:
    """Rewrites the recent dates of both Gold tables, clustered for the usual filters."""
    for path, ddl, by in [
        (tables.daily_kpis, DAILY_KPIS_DDL, ["event_date", "service"]),
        (tables.sessions, SESSIONS_DDL, ["event_date", "user_id"]),
    ]:
        recent = incremental(read_table(spark, path, ddl), as_of, days)
        clustered = compact(recent, by, files)
        clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "event_date"
        ).parquet(path)


def run_silver(
    spark: SparkSession,
    raw: str,
    tables: Tables,
    as_of: dt.date | None = None,
    days: int = 1,
    at: Column | None = None,
    load: str | None = None,
) -> list[dt.date | None] | None:
    """The first two stages; gives the recomputed dates, None for all."""
    load = load_bronze(spark, raw, tables, at, load)
    dates = None
    if as_of is not None:
        dates = touched_dates(spark, tables.bronze, load)
        recent = {as_of - i * DAY for i in range(days + 1)}
        dates = None if dates is None else [*recent, *(d for d in dates if d not in recent)]
    refresh_silver(spark, tables, dates)
    return dates


def run_tables(
    spark: SparkSession,
    raw: str,
    root: str,
    as_of: dt.date | None = None,
    days: int = 1,
    at: Column | None = None,
    exact: bool = False,
    databases: Sequence[str] | None = None,
) -> Tables:
    """The stages in order; without ``as_of`` everything is recomputed.

    With it, the dates that the new files touch are recomputed, however old, and the
    ``days`` up to ``as_of``. With ``databases`` (of Bronze, Silver and Gold) the tables are
    declared in the catalog too and can be read by name; of their partitions, those of the
    recomputed dates are brought up to date.
    """
    tables, load = Tables(root), uuid.uuid4().hex
    names = create_tables(spark, root, databases) if databases else []
    dates = run_silver(spark, raw, tables, as_of, days, at, load)
    done = refresh_gold(spark, tables, dates, at, exact)
    if as_of is not None:
        compact_gold(spark, tables, as_of, days)
    if names and dates is None:
        publish_tables(spark, names)
    elif names:
        arrived = date_values(read_load(spark, tables.bronze, load)) or []
        changed = [(tables.bronze, arrived, load), (tables.silver, dates, None)]
        changed += [(p, sorted({*done, *filter(None, dates)}), None) for p in (tables.daily_kpis, tables.sessions)]
        for name, (path, some, part) in zip(names, changed, strict=True):
            publish_dates(spark, name, path, some, part)
    return tables
