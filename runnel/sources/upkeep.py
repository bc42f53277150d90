"""Upkeep of Bronze: the small files of many loads are put together, date by date.

Which files go together follows from a listing alone. A file is never cut: a merged file
holds whole files, and its rows keep the name of the file that they came in, by which
quarantine and quality notes know them. The names of merged loads are kept, so a load that
is repeated after its merge changes nothing.

A round writes its merged files aside, then moves them in and deletes the old ones by its
plan. One that broke off before it had written everything leaves no trace; a later one is
completed by the next call. Loads and streams must not run meanwhile: between moving and
deleting rows are there twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runnel.schemas import DATE_COL, LOAD_COL, STORED_DDL, column_names
from runnel.sources.keyindex import KEYS, STRAYS, fold_loads
from runnel.sources.tables import (
    DONE,
    LOADED_DDL,
    MERGED,
    NULL_PARTITION,
    delete_folders,
    first_file,
    publish_tables,
    read_table,
    table_exists,
)

TARGET_BYTES = 256 * 1024**2
#: Files of one round: so many names pass through the driver.
ROUND_FILES = 10_000
#: Folder inside Bronze for rounds that are not finished; readers pass over it.
MERGING = "_merging"
PLAN_DDL = f"path STRING, {DATE_COL} DATE, {LOAD_COL} STRING, file STRING, bin BIGINT"


def stored_files(spark: SparkSession, bronze: str) -> DataFrame:
    """``path, event_date, _load, file, bytes`` of all data files, without opening them."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(bronze)
    )
    pattern = f"/{DATE_COL}=([^/]+)/{LOAD_COL}=([^/]+)/([^/]+)$"
    day, load, file = (F.regexp_extract("path", pattern, i) for i in (1, 2, 3))
    return listed.where(F.col("path").rlike(pattern)).select(
        "path",
        F.when(day != NULL_PARTITION, day).cast("date").alias(DATE_COL),
        # Spark escapes folder names as URLs, but for plus signs and blanks.
        F.url_decode(F.replace(load, F.lit("+"), F.lit("%2B"))).alias(LOAD_COL),
        file.alias("file"),
        F.col("length").alias("bytes"),
    )


def plan_bins(files: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """The files under half of ``target`` that can be merged, with the number of their bin.

    The files of a date are laid end to end and cut where a multiple of ``target`` is
    passed, so a bin holds half to one and a half of it, but for the last one of a date.
    A bin of one file stays as it is.
    """
    in_order = Window.partitionBy(DATE_COL).orderBy(LOAD_COL, "file")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    small = files.where(F.col("bytes") * 2 < target)
    binned = small.withColumn("bin", F.floor(start / target).cast("bigint"))
    together = F.count(F.lit(1)).over(Window.partitionBy(DATE_COL, "bin"))
    return binned.withColumn("_n", together).where("_n > 1").select(*column_names(PLAN_DDL))


def _files(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names_in(spark: SparkSession, path: str) -> list[str]:
    system, folder = _files(spark, path)
    return [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []


def _stage(spark: SparkSession, bronze: str, run: str, plan: list) -> None:
    """Writes the plan and the merged rows of a round aside, a file for each bin."""
    aside = f"{bronze}/{MERGING}/{run}"
    chosen = spark.createDataFrame(plan, PLAN_DDL)
    chosen.coalesce(1).write.parquet(f"{aside}/plan")
    reader = spark.read.schema(f"{STORED_DDL}, {LOAD_COL} STRING").option("basePath", bronze)
    rows = first_file(reader.parquet(*[r["path"] for r in plan]), keep_name="_stored")
    bins = chosen.select(
        F.col(DATE_COL).alias("_date"),
        F.col(LOAD_COL).alias("_name"),
        "file",
        F.concat(F.lit(f"{run}-"), F.col("bin")).alias("_merged"),
    )
    same = (
        F.col(DATE_COL).eqNullSafe(F.col("_date"))
        & (F.col(LOAD_COL) == F.col("_name"))
        & (F.col("_stored") == F.col("file"))
    )
    # The plan has at most ROUND_FILES rows.
    placed = rows.join(F.broadcast(bins), same)
    merged = placed.select(*column_names(STORED_DDL), F.col("_merged").alias(LOAD_COL))
    together = merged.repartition(DATE_COL, LOAD_COL)
    together.write.partitionBy(DATE_COL, LOAD_COL).parquet(f"{aside}/rows")


def _finish(spark: SparkSession, bronze: str, run: str) -> None:
    """Moves a round's files in and deletes those that they replace; each step can be
    repeated. A round that was not written whole is dropped."""
    aside = f"{bronze}/{MERGING}/{run}"
    if "_SUCCESS" not in _names_in(spark, f"{aside}/rows"):
        delete_folders(spark, [aside])
        return
    plan = spark.read.schema(PLAN_DDL).parquet(f"{aside}/plan").collect()
    loads = sorted({(r[LOAD_COL],) for r in plan})
    noted = spark.createDataFrame(loads, LOADED_DDL).withColumn("run", F.lit(run)).coalesce(1)
    noted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run"
    ).parquet(f"{bronze}/{MERGED}")
    for day in (n for n in _names_in(spark, f"{aside}/rows") if "=" in n):
        for part in _names_in(spark, f"{aside}/rows/{day}"):
            system, target = _files(spark, f"{bronze}/{day}/{part}")
            if not system.exists(target):
                system.rename(_files(spark, f"{aside}/rows/{day}/{part}")[1], target)
    delete_folders(spark, [r["path"] for r in plan])
    folders = sorted({r["path"].rsplit("/", 1)[0] for r in plan})
    delete_folders(spark, [f for f in folders if not _names_in(spark, f)])
    left = stored_files(spark, bronze).select(LOAD_COL).distinct()
    gone = spark.createDataFrame(loads, LOADED_DDL).join(left, LOAD_COL, "left_anti").collect()
    fold_loads(spark, bronze, [r[0] for r in gone], run)
    for root in [f"{bronze}/{STRAYS}", *(f"{bronze}/{KEYS}/{n}" for n in _names_in(spark, f"{bronze}/{KEYS}"))]:
        held = set(_names_in(spark, root))
        old = [f"{LOAD_COL}={r['path'].rsplit('/', 2)[1].split('=', 1)[1]}" for r in plan if (r[LOAD_COL],) in gone]
        delete_folders(spark, [f"{root}/{n}" for n in sorted(held & set(old))])
    delete_folders(spark, [aside])


def merge_loads(
    spark: SparkSession,
    bronze: str,
    target: int = TARGET_BYTES,
    round_files: int = ROUND_FILES,
    name: str | None = None,
) -> int:
    """Merges the small files of each date; gives the number of files that were replaced.

    Afterwards a date has at most two files for each ``target`` bytes, and one more. Only
    loads that ended are taken, with their ids in the index; loads written by other tools
    stay. Streams that read Bronze meet merged rows once more, under their old file's name.
    ``name`` is the table's name in a catalog, which is brought up to date.
    """
    for run in _names_in(spark, f"{bronze}/{MERGING}"):
        _finish(spark, bronze, run)
    replaced = 0
    while table_exists(spark, f"{bronze}/{DONE}"):
        ended = read_table(spark, f"{bronze}/{DONE}", LOADED_DDL, keep_load=True)
        if table_exists(spark, f"{bronze}/{MERGED}"):
            before = spark.read.parquet(f"{bronze}/{MERGED}").select("run").distinct()
        else:
            before = spark.createDataFrame([], "run STRING")
        files = stored_files(spark, bronze)
        own = files.join(ended.distinct(), LOAD_COL, "left_semi")
        made = files.join(before, F.substring_index(LOAD_COL, "-", 2) == F.col("run"), "left_semi")
        bins = plan_bins(own.unionByName(made), target)
        plan = bins.orderBy(DATE_COL, "bin", LOAD_COL, "file").limit(round_files).collect()
        sizes: dict[tuple, int] = {}
        for r in plan:
            sizes[r[DATE_COL], r["bin"]] = sizes.get((r[DATE_COL], r["bin"]), 0) + 1
        plan = [r for r in plan if sizes[r[DATE_COL], r["bin"]] > 1]
        if not plan:
            break
        run = f"merged-{uuid.uuid4().hex}"
        _stage(spark, bronze, run, plan)
        _finish(spark, bronze, run)
        replaced += len(plan)
    if name and replaced:
        publish_tables(spark, [name])
    return replaced
