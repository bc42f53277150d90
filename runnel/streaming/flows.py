"""Structured Streaming form of the three stages.

Each starts an ``availableNow`` query that handles what has arrived and stops. A backlog is
cut into micro-batches by ``max_bytes``. Every batch can be repeated after a failure
without changing the result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runnel.functions.columns import now_or
from runnel.operators.gold import daily_kpis
from runnel.operators.layout import cache_if_reused
from runnel.operators.quality import (
    dedup_latest,
    quality_by_file,
    quality_of_files,
    split_nulls,
)
from runnel.operators.sessions import resumable_sessions
from runnel.operators.silver import to_bronze, to_silver
from runnel.plans.medallion import (
    EMPTIED,
    NOTE_DDL,
    refresh_gold_dates,
    replace_silver,
    session_rows_before,
)
from runnel.schemas import (
    DATE_COL,
    FILE_COL,
    LOAD_COL,
    QUALITY_DDL,
    QUARANTINE_DDL,
    SILVER_DDL,
    STORED_DDL,
)
from runnel.sources.keyindex import STRAYS, copies_of, index_bronze, silver_date
from runnel.sources.raw import parse_raw_lines
from runnel.sources.tables import (
    append_bronze,
    date_values,
    first_file,
    make_folder,
    read_dates,
    read_dates_of,
    read_table,
    replace_dates,
    table_exists,
)

MAX_BYTES = 512 * 1024**3


def stream_bronze(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    ingested_at: Column | None = None,
    max_bytes: int = MAX_BYTES,
) -> StreamingQuery:
    """New JSON files to Bronze, each file once; ``load_bronze`` may add to the same table."""
    lines = (
        spark.readStream.option("maxBytesPerTrigger", max_bytes)
        .option("recursiveFileLookup", True)
        .text(src)
        .select("value", F.col("_metadata.file_path").alias("_source_file"))
    )

    def add(batch: DataFrame, number: int) -> None:
        rows = parse_raw_lines(batch).withColumn("_ingested_at", now_or(ingested_at))
        append_bronze(to_bronze(rows), out, batch_name(batch, number))

    return (
        lines.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_name(batch: DataFrame, number: int) -> str:
    """The stream's id, which lies in its checkpoint, with the number of the batch."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream}-{number}"


def add_to_quarantine(rejected: DataFrame, quarantine: str) -> None:
    """Puts a batch's rejects beside those of other batches and of the batch flow.

    Rejects are known by their Bronze file, here as in the batch flow. Those of the same
    files are replaced, so neither a repeated batch nor the other flow doubles them.
    """
    spark = rejected.sparkSession
    # Few rows, which are looked for in the whole batch once.
    rejected = cache_if_reused(rejected)
    try:
        dates = date_values(rejected)
        if dates == []:
            return
        if dates is not None:
            held = read_dates(spark, quarantine, dates, QUARANTINE_DDL)
        elif table_exists(spark, quarantine):
            held = read_table(spark, quarantine, QUARANTINE_DDL)
        else:
            held = spark.createDataFrame([], QUARANTINE_DDL)
        # Files of one load share a name, and a batch may end between its dates.
        files = rejected.select(F.col(DATE_COL).alias("_date"), F.col(FILE_COL).alias("_file"))
        same = F.col(DATE_COL).eqNullSafe(F.col("_date")) & (F.col(FILE_COL) == F.col("_file"))
        others = held.join(files.distinct(), same, "left_anti")
        replace_dates(others.unionByName(rejected, allowMissingColumns=True), quarantine)
    finally:
        rejected.unpersist()


def add_to_silver(batch: DataFrame, bronze: str, silver: str, quarantine: str) -> None:
    """Cleans one batch of Bronze rows and puts it into Silver; of copies the latest counts.

    Older copies may lie on any date; the index of Bronze says on which. The dates of the
    batch and of these copies are read, merged and replaced, so a repeated batch changes
    nothing; no other date is read. ``batch`` has the name of its Bronze file.
    """
    spark = batch.sparkSession
    kept, rejected = split_nulls(batch.drop(LOAD_COL))
    add_to_quarantine(rejected, quarantine)
    valid = kept.select("event_id", silver_date().alias(DATE_COL))
    copies = copies_of(spark, bronze, valid)
    touched = valid.select(DATE_COL).unionByName(copies.select(F.col("silver_date").alias(DATE_COL)))
    dates = date_values(touched)
    if dates is None:
        held = read_dates_of(spark, silver, touched, SILVER_DDL)
    else:
        held = read_dates(spark, silver, dates, SILVER_DDL)
    # Copies within the batch and those in Silver are told apart by one shuffle.
    latest = dedup_latest(to_silver(kept).unionByName(held))
    replace_silver(latest, silver, touched if dates is None else dates)


def stream_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    quarantine: str,
    checkpoint: str,
    max_bytes: int = MAX_BYTES,
    quality: str | None = None,
) -> StreamingQuery:
    """New Bronze files to Silver and quarantine, their counts to ``quality`` if that is given.

    Bronze written by other tools than this library is indexed first, if it has no index.
    Files that were merged since a batch was planned are passed over: their rows come with
    the merged file, which changes nothing where they were taken before.
    """
    if not table_exists(spark, f"{bronze}/{STRAYS}"):
        index_bronze(spark, bronze)

    def add(batch: DataFrame, _: int) -> None:
        add_to_silver(batch, bronze, silver, quarantine)
        if quality:
            # After a failure the batch comes again, and with it the same notes.
            quality_by_file(batch).write.mode("append").parquet(quality)

    reader = spark.readStream.schema(STORED_DDL).option("maxBytesPerTrigger", max_bytes)
    rows = first_file(reader.option("ignoreMissingFiles", True).parquet(bronze))
    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quality_so_far(spark: SparkSession, quality: str, silver: str) -> DataFrame:
    """Counts of all rows that ``stream_silver`` has cleaned, as ``dq_summary`` gives them.

    Reads the notes of the batches and the number of rows in Silver, no events. Silver must
    be filled from the noted files alone.
    """
    held = read_table(spark, silver, SILVER_DDL)
    return quality_of_files(read_table(spark, quality, QUALITY_DDL), held)


def refresh_touched(
    batch: DataFrame,
    silver: str,
    kpis: str,
    sessions: str,
    computed_at: Column | None = None,
    exact: bool = False,
) -> None:
    """Recomputes Gold from Silver for the dates of one batch, late events included.

    A late event can join sessions of the next dates; these follow as far as they change.
    """
    spark = batch.sparkSession
    dated = batch.where("event_date IS NOT NULL").select(DATE_COL)
    dates = date_values(dated)
    if dates is not None:
        refresh_gold_dates(spark, silver, kpis, sessions, dates, computed_at, exact)
        return
    touched = read_dates_of(spark, silver, dated, SILVER_DDL)
    replace_dates(daily_kpis(touched, computed_at, exact), kpis, dated)
    first: dt.date = dated.agg(F.min("event_date")).first()[0]
    since = read_table(spark, silver, SILVER_DDL).where(F.col("event_date") >= F.lit(first))
    before = session_rows_before(spark, sessions, first)
    replace_dates(resumable_sessions(since, before, computed_at), sessions, dated)


def stream_gold(
    spark: SparkSession,
    silver: str,
    kpis: str,
    sessions: str,
    checkpoint: str,
    computed_at: Column | None = None,
    exact: bool = False,
    max_bytes: int = MAX_BYTES,
) -> StreamingQuery:
    """New Silver files, and notes of emptied dates, to both Gold tables.

    A file that a later batch has replaced meanwhile is passed over: its date comes again
    with the new file or with the note that it was emptied.
    """
    make_folder(spark, f"{silver}/{EMPTIED}")
    reader = spark.readStream.option("maxBytesPerTrigger", max_bytes)
    reader = reader.option("ignoreMissingFiles", True)
    written = reader.schema(SILVER_DDL).parquet(silver).select(DATE_COL)
    emptied = reader.schema(NOTE_DDL).parquet(f"{silver}/{EMPTIED}")
    return (
        written.unionByName(emptied)
        .writeStream.foreachBatch(
            lambda batch, _: refresh_touched(batch, silver, kpis, sessions, computed_at, exact)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
