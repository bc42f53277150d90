"""Parquet tables by path, partitioned by date."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from runnel.operators.history import history_as_of, scd2_apply, scd2_splice, scd2_stage
from runnel.operators.layout import compact, repartition_by_date
from runnel.operators.upsert import require_unique, upsert
from runnel.plans.sizing import materialise
from runnel.schemas import (
    BRONZE_DDL,
    DAILY_KPIS_DDL,
    DATE_COL,
    FILE_COL,
    LOAD_COL,
    SESSIONS_DDL,
    SILVER_DDL,
)
from runnel.sources.keyindex import index_load, load_folder

#: Most bytes of a row group's Bloom filter: about 1 % wrong hits at 6 million values.
BLOOM_BYTES = 8 * 1024**2
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
MAX_DATES = 5_000
#: Folder of a stored history with its load numbers; readers pass over the underscore.
LOADS = "_loads"
#: Folder of an upserted table with its columns as JSON.
SCHEMA = "_columns"
LOADS_DDL = "version BIGINT, at TIMESTAMP_NTZ"
#: Folders of Bronze: the loads that ended, and those whose files were merged.
DONE, MERGED = "_done", "_merged"
LOADED_DDL = f"{LOAD_COL} STRING"
#: Folder of a stored history with the keys that loads did not have.
MISSED = "_missed"
#: Number of the row that says up to when closed versions were dropped.
PRUNED = -1


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if _absent(error):
            return False
        raise
    return True


def read_table(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    merge: bool = False,
    keep_load: bool = False,
) -> DataFrame:
    """Reads a table. With a schema, files of an older one give null in the newer columns;
    ``merge`` finds the union of all files' columns instead, by reading every footer.
    """
    if not schema:
        return spark.read.option("mergeSchema", merge).parquet(path)
    found = spark.read.schema(schema).parquet(path)
    return found if keep_load else found.drop(LOAD_COL)


def first_file(rows: DataFrame, keep_name: str | None = None) -> DataFrame:
    """Stored Bronze rows with the name of the file in which they arrived, also where files
    were merged since; and with the name of the file that was read, as ``keep_name``."""
    name = F.col("_metadata.file_name")
    named = {FILE_COL: F.coalesce(FILE_COL, name), **({keep_name: name} if keep_name else {})}
    return rows.withColumns(named)


def read_dates(
    spark: SparkSession, path: str, dates: Sequence[dt.date | None], schema: str | StructType
) -> DataFrame:
    """Reads some dates of a table, listing only their folders; absent dates give no rows."""
    names = sorted({NULL_PARTITION if d is None else d.isoformat() for d in dates})
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(f"{path}/{DATE_COL}={{{','.join(names)}}}")
    except AnalysisException as error:
        if _absent(error):
            return spark.createDataFrame([], schema)
        raise


def date_values(df: DataFrame) -> list[dt.date | None] | None:
    """The dates that occur in ``df``, or None if there are more than ``MAX_DATES``."""
    found = df.select(DATE_COL).distinct().limit(MAX_DATES + 1).collect()
    return [r[0] for r in found] if len(found) <= MAX_DATES else None


def read_dates_of(
    spark: SparkSession, path: str, df: DataFrame, schema: str | StructType
) -> DataFrame:
    """Reads the dates that occur in ``df``; if they are too many, by a semi-join."""
    found = date_values(df)
    if found is not None:
        return read_dates(spark, path, found, schema)
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    dates = df.select(F.col(DATE_COL).alias("_date")).distinct()
    whole = read_table(spark, path, schema)
    return whole.join(dates, F.col(DATE_COL).eqNullSafe(F.col("_date")), "left_semi")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_cols: Sequence[str] = (DATE_COL,),
    dynamic: bool = False,
    gather: bool = True,
) -> None:
    """Writes a table. ``dynamic`` overwrites only the partitions that occur in ``df``.

    ``gather`` brings the rows of a partition together first; without it nothing is
    shuffled, which suits input whose files already hold few dates each.
    """
    if partition_cols and gather:
        df = repartition_by_date(df, partition_cols[0])
    writer = df.write.mode(mode).partitionBy(*partition_cols)
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)


def replace_dates(
    df: DataFrame, path: str, dates: Sequence[dt.date | None] | DataFrame | None = None
) -> list[dt.date | None]:
    """Replaces the dates that occur in ``df``; running it again changes nothing.

    Of ``dates`` (a list, or a frame of them), those without rows in ``df`` are emptied; they
    are given back. Which dates occur is observed while they are written, so ``df`` is
    computed once; it may read the same table.
    """
    seen = Observation()
    # Behind the exchange, so that empty input is observed too and not optimised away.
    written = repartition_by_date(df).observe(
        seen,
        F.collect_set(F.col(DATE_COL).cast("string")).alias("dates"),
        F.count_if(F.col(DATE_COL).isNull()).alias("undated"),
    )
    write_table(written, path, "overwrite", dynamic=True, gather=False)
    if dates is None:
        return []
    if isinstance(dates, DataFrame):
        dates = [r[0] for r in dates.select(DATE_COL).distinct().collect()]
    found: set[dt.date | None] = {dt.date.fromisoformat(d) for d in seen.get["dates"]}
    if seen.get["undated"]:
        found.add(None)
    emptied = [d for d in dates if d not in found]
    drop_dates(df.sparkSession, path, emptied)
    return emptied


def _folder(value: dt.date | None) -> str:
    return f"{DATE_COL}={NULL_PARTITION if value is None else value.isoformat()}"


def drop_dates(spark: SparkSession, path: str, dates: Sequence[dt.date | None]) -> None:
    """Deletes the folders of some dates; absent ones are passed over."""
    delete_folders(spark, [f"{path}/{_folder(value)}" for value in dates])


def delete_folders(spark: SparkSession, paths: Sequence[str]) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in paths:
        folder = hadoop(name)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Appends rejected rows; an empty frame adds no rows, so nothing is counted first."""
    df.write.mode("append").parquet(path)


def stored_schema(spark: SparkSession, path: str) -> StructType:
    """The columns of an upserted table by its note; without one, of all files' footers."""
    try:
        noted = spark.read.text(f"{path}/{SCHEMA}").first()
    except AnalysisException as error:
        if not _absent(error):
            raise
        noted = None
    if noted is None:
        return read_table(spark, path, merge=True).schema
    return StructType.fromJson(json.loads(noted[0]))


def _store_schema(source: DataFrame, path: str, stored: StructType | None = None) -> None:
    """Notes the columns of a table with those of new rows, if they are not noted yet."""
    known = stored.fieldNames() if stored else []
    fields = [*(stored or []), *(f for f in source.schema if f.name not in known)]
    if len(fields) > len(known):
        noted = source.sparkSession.createDataFrame([(StructType(fields).json(),)], "value STRING")
        noted.coalesce(1).write.mode("overwrite").text(f"{path}/{SCHEMA}")


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> None:
    """Replaces matching rows and adds the others, rewriting only the touched dates.

    ``keys`` contains the date, so rows that match lie in a touched partition. Columns that
    only the target or only the source has are kept. Two source rows with one key are an
    error. Each row of the source is computed once, and the table's columns are read from
    its note, not from all its files.
    """
    if not table_exists(spark, path):
        require_unique(source, keys)
        write_table(source, path, "overwrite")
        _store_schema(source, path)
        return
    source, _ = materialise(source)
    require_unique(source, keys)
    stored = stored_schema(spark, path)
    _store_schema(source, path, stored)
    touched = read_dates_of(spark, path, source, stored)
    replace_dates(upsert(touched, source, keys), path)


def _open_versions(path: str) -> str:
    return f"{path}/{LOAD_COL}=current"


def append_load(df: DataFrame, path: str, load: str) -> None:
    """Adds rows under the name of a load; repeating it with that name adds nothing more.

    Input files that hold few dates each need no shuffle before the write.
    """
    named = df.withColumn(LOAD_COL, F.lit(load))
    write_table(named, path, "overwrite", (DATE_COL, LOAD_COL), dynamic=True, gather=False)


def append_bronze(df: DataFrame, path: str, load: str) -> None:
    """Adds a load of Bronze rows, and their ids to the table's index; then notes that it
    ended. A load whose files were merged since is there, and is passed over."""
    spark = df.sparkSession
    if table_exists(spark, f"{path}/{MERGED}"):
        merged = read_table(spark, f"{path}/{MERGED}", LOADED_DDL, keep_load=True)
        if not merged.where(F.col(LOAD_COL) == load).isEmpty():
            return
    append_load(df, path, load)
    index_load(spark, path, load)
    ended = spark.createDataFrame([(load,)], LOADED_DDL).coalesce(1)
    ended.write.mode("append").parquet(f"{path}/{DONE}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Reads a stored history, open and closed versions."""
    return read_table(spark, path).drop(LOAD_COL)


def upsert_history(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: str,
    compare_cols: Sequence[str],
    at: Column,
) -> None:
    """Loads a snapshot into a stored history; the first load creates it.

    Open versions lie in one partition, the versions closed by a load in one of their own.
    A load reads and rewrites the open ones only. It stores the closed versions first, so
    a run that broke off can be repeated with the same ``at``. ``at`` must not lie before an
    earlier load, nor name another snapshot's load; keys must be unique in the snapshot.
    Loads are numbered from 0, for :func:`read_version`; the numbers stay when versions are
    dropped. Keys that the snapshot lacks are noted for :func:`splice_history`, which takes
    loads that come late.
    """
    require_unique(new, [key])
    load = _version_folder()
    if not table_exists(spark, _open_versions(path)):
        first = scd2_stage(new, compare_cols, at).withColumn(LOAD_COL, load)
        write_table(first, path, "overwrite", [LOAD_COL])
        _number_load(spark, path, at)
        return
    opened = spark.read.parquet(_open_versions(path))
    applied, _ = materialise(
        scd2_apply(opened, new, key, compare_cols, at, "_given").withColumn(LOAD_COL, load)
    )
    last = opened.select(
        F.max(F.col("effective_start_date") > at), F.max(F.col("effective_start_date") == at)
    ).first()
    if last[0] or (last[1] and not applied.where("NOT is_current").isEmpty()):
        raise ValueError("a load must be later than every load before it")
    _note_missed(applied.where("is_current AND NOT _given").select(key, at.alias("at")), path, at)
    applied = applied.drop("_given")
    for part in (applied.where("NOT is_current"), applied.where("is_current")):
        write_table(part, path, "overwrite", [LOAD_COL], dynamic=True)
    _number_load(spark, path, at)


def _stamp(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyyMMddHHmmssSSSSSS")


def _version_folder() -> Column:
    """Where a version lies: with the open ones, or with those that ended at the same time."""
    return F.when(F.col("is_current"), "current").otherwise(_stamp("effective_end_date"))


def _note_missed(keys: DataFrame, path: str, at: Column) -> None:
    named = keys.withColumn(LOAD_COL, _stamp(at))
    write_table(named, f"{path}/{MISSED}", "overwrite", [LOAD_COL], dynamic=True)


def _missed(spark: SparkSession, path: str, key: str, kind: str) -> DataFrame:
    try:
        return spark.read.schema(f"`{key}` {kind}, at TIMESTAMP_NTZ, {LOAD_COL} STRING").parquet(
            f"{path}/{MISSED}"
        )
    except AnalysisException as error:
        if _absent(error):
            return spark.createDataFrame([], f"`{key}` {kind}, at TIMESTAMP_NTZ, {LOAD_COL} STRING")
        raise


def splice_history(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: str,
    compare_cols: Sequence[str],
    at: Column,
) -> None:
    """Loads a snapshot of an earlier time between those of a stored history.

    The history is then as if all had been loaded in order. Only versions that end after
    ``at`` are read, and only folders in which a version changed are written. Which loads
    had a key is known from the notes of :func:`upsert_history`; a history stored without
    notes counts as made of whole snapshots. The load takes the next number. Repeating it
    changes nothing; another snapshot for the time of a known load is an error, as is a time
    of which versions have been dropped.
    """
    require_unique(new, [key])
    loads = _loads(spark, path)
    limit = loads.where(F.col("version") == PRUNED).agg(F.max("at")).scalar()
    made = loads.where(F.col("version") >= 0)
    if not loads.where(at < limit).isEmpty():
        raise ValueError(f"versions of that time of {path} have been dropped")
    later = made.where(F.col("at") > at).agg(F.array_sort(F.collect_list("at"))).scalar()
    missed = _missed(spark, path, key, new.schema[key].dataType.simpleString())
    stored = read_table(spark, path).where(F.col(LOAD_COL) > _stamp(at))
    spliced = scd2_splice(
        stored.drop(LOAD_COL), new, key, compare_cols, at, later, missed.select(key, "at")
    )
    spliced, _ = materialise(spliced.withColumn(LOAD_COL, _version_folder()))
    moved = spliced.where("_moved")
    if not made.where(F.col("at") == at).isEmpty():
        if not moved.isEmpty():
            raise ValueError("another snapshot was loaded at that time")
        return
    if missed.where(F.col(LOAD_COL) == _stamp(at)).isEmpty():
        # Not in this snapshot; and keys that it begins, not in the loads up to their next version.
        without = spliced.where(~F.col("_given") & (F.col("_since") <= at)).select(key, at.alias("at"))
        begun = moved.where((F.col("_since") > at) | F.col("_since").isNull())
        between = F.filter("_later", lambda x: F.col("_since").isNull() | (x < F.col("_since")))
        begun = begun.withColumn("_later", later).select(key, F.explode(between).alias("at"))
        _note_missed(without.unionByName(begun), path, at)
    old = F.array(F.col(LOAD_COL), F.col("_was"))
    before = stored.select(F.col(key).alias("_k"), F.col("effective_start_date").alias("_s"), F.col(LOAD_COL).alias("_was"))
    left = moved.join(before, (F.col(key) == F.col("_k")) & (F.col("_since") == F.col("_s")), "left")
    touched = [r[0] for r in left.select(F.explode(old).alias("f")).distinct().where("f IS NOT NULL").collect()]
    if touched:
        rows = spliced.where(F.col(LOAD_COL).isin(touched)).drop("_given", "_since", "_moved")
        written = [r[0] for r in rows.select(LOAD_COL).distinct().collect()]
        write_table(rows, path, "overwrite", [LOAD_COL], dynamic=True)
        delete_folders(spark, [f"{path}/{LOAD_COL}={f}" for f in touched if f not in written])
    _number_load(spark, path, at)


def _loads(spark: SparkSession, path: str) -> DataFrame:
    """One row for each load: a short table, as loads are made one after the other."""
    try:
        return spark.read.schema(LOADS_DDL).parquet(f"{path}/{LOADS}")
    except AnalysisException as error:
        if _absent(error):
            return spark.createDataFrame([], LOADS_DDL)
        raise


def _number_load(spark: SparkSession, path: str, at: Column) -> None:
    known = _loads(spark, path).where(F.col("version") >= 0)
    if known.where(F.col("at") == at).isEmpty():
        row = known.agg((F.coalesce(F.max("version"), F.lit(-1)) + 1).alias("version"))
        row.select("version", at.alias("at")).write.mode("append").parquet(f"{path}/{LOADS}")


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The versions valid after the load of that number, counted from 0.

    An error if there is no such load or if versions of that time have been dropped.
    """
    loads = _loads(spark, path)
    limit = loads.where(F.col("version") == PRUNED).agg(F.max("at")).scalar()
    found = loads.where(F.col("version") == version).select(
        "at", F.coalesce(F.col("at") < limit, F.lit(False)).alias("gone")
    )
    row = found.first() if version >= 0 else None
    if row is None:
        raise ValueError(f"{path} has no load {version}")
    if row["gone"]:
        raise ValueError(f"versions of load {version} of {path} have been dropped")
    return history_as_of(read_history(spark, path), F.lit(row["at"]).cast("timestamp_ntz"))


def prune_history(spark: SparkSession, path: str, as_of: Column, hours: int = 168) -> None:
    """Drops versions closed more than ``hours`` before ``as_of``, by whole loads.

    What is dropped is noted first, so a run that broke off can be repeated.
    """
    limit = as_of - F.make_dt_interval(hours=F.lit(hours))
    closed = read_table(spark, path).where("NOT is_current").groupBy(LOAD_COL)
    old = closed.agg(F.max("effective_end_date").alias("at")).where(F.col("at") < limit)
    old, rows = materialise(old)
    if not rows:
        return
    note = old.agg(F.lit(PRUNED).cast("bigint").alias("version"), F.max("at").alias("at"))
    note.write.mode("append").parquet(f"{path}/{LOADS}")
    delete_folders(spark, [f"{path}/{LOAD_COL}={r[0]}" for r in old.select(LOAD_COL).collect()])


def compact_table(
    spark: SparkSession,
    source: str,
    target: str,
    cols: Sequence[str] | None = None,
    files: int | None = None,
    schema: str | StructType | None = None,
    curve: str = "z",
    lookup_cols: Sequence[str] = (),
) -> None:
    """Rewrites a table into a new path, clustered along ``cols``.

    Row groups get a Bloom filter for each of ``lookup_cols``, sized by the values that it
    holds, so that reading one value passes over the row groups without it.
    """
    clustered = compact(read_table(spark, source, schema), cols, files, curve)
    writer = clustered.write.mode("errorifexists")
    for c in lookup_cols:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{c}", True)
            .option(f"parquet.bloom.filter.adaptive.enabled#{c}", True)
            .option(f"parquet.bloom.filter.max.bytes#{c}", BLOOM_BYTES)
        )
    writer.parquet(target)


def create_tables(
    spark: SparkSession, root: str, databases: Sequence[str] = ("bronze", "silver", "gold")
) -> list[str]:
    """Declares the databases and the four tables of the flow below ``root``; gives the names."""
    comments = ["events as received", "checked and typed events", "indicators and sessions"]
    for name, comment in zip(databases, comments, strict=True):
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{root}/{name}'"
        )
    bronze, silver, gold = databases
    loaded = f"{BRONZE_DDL}, {LOAD_COL} STRING"
    tables = [
        (bronze, "bronze/raw_logs", loaded, "raw log events as received"),
        (silver, "silver/logs_cleaned", SILVER_DDL, "cleaned, typed, deduplicated log events"),
        (gold, "gold/daily_kpis", DAILY_KPIS_DDL, "daily indicators per service and region"),
        (gold, "gold/session_summary", SESSIONS_DDL, "per-user session summaries"),
    ]
    names = []
    for database, folder, ddl, comment in tables:
        names.append(f"{database}.{folder.split('/')[1]}")
        parts = f"{DATE_COL}, {LOAD_COL}" if ddl == loaded else DATE_COL
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {names[-1]} ({ddl}) USING parquet "
            f"PARTITIONED BY ({parts}) COMMENT '{comment}' LOCATION '{root}/{folder}'"
        )
    return names


def publish_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Makes the catalog tables show the partitions that their folders hold now."""
    for name in names:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def publish_dates(
    spark: SparkSession,
    name: str,
    path: str,
    dates: Sequence[dt.date | None],
    load: str | None = None,
) -> None:
    """Makes a catalog table show some dates as their folders are now, added or emptied.

    The cost follows the dates given, not the partitions that the table has. ``load`` names
    the load of a Bronze table whose dates they are.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    below = f"/{load_folder(spark, load)}" if load else ""
    there: dict[bool, list[str]] = {True: [], False: []}
    for value in dates:
        folder = hadoop(f"{path}/{_folder(value)}{below}")
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        day = "NULL" if value is None else f"DATE '{value.isoformat()}'"
        part = f"{DATE_COL}={day}" + (f", {LOAD_COL}='{load}'" if load else "")
        there[system.exists(folder)].append(f"PARTITION ({part})")
    if there[True]:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(there[True])}")
    if there[False]:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(there[False])}")
    spark.catalog.refreshTable(name)


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per catalog table with its row count."""
    counts = [
        spark.table(n).agg(F.lit(n.split(".")[-1]).alias("table_name"), F.count("*").alias("cnt"))
        for n in names
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
