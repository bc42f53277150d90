"""Index of event ids: on which dates the copies of an event lie.

It lies in two folders inside a Bronze table, which readers of the table pass over:

* ``_keys`` has one row for each id, load and date, in folders by hash bucket and load and
  sorted by id. A new load looks its ids up in the buckets that they fall into.
* ``_strays`` has the ids that a single date does not show whole: those with copies on
  several dates, and those whose raw date is not their Silver date. They are few, so a run
  that recomputes some dates learns from this table alone which other dates it needs.

A load writes its own folders, so repeating it under its name changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runnel.functions.columns import event_time
from runnel.operators.layout import cache_if_reused
from runnel.operators.quality import any_null
from runnel.schemas import BRONZE_DDL, CRITICAL_COLS, DATE_COL, LOAD_COL, column_names

KEYS, STRAYS = "_keys", "_strays"
#: Hash buckets of the ids. A stored index keeps the number that it was made with.
BUCKETS = 32
KEY_DDL = "event_id STRING, bronze_date DATE, silver_date DATE"
KEYS_DDL = f"{KEY_DDL}, bucket INT, {LOAD_COL} STRING"
STRAYS_DDL = f"{KEY_DDL}, {LOAD_COL} STRING"


def silver_date() -> Column:
    """The Silver date of a Bronze row."""
    return F.to_date(event_time("timestamp"))


def bucket_of(event_id: str = "event_id") -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, root: str, ddl: str, below: str = "") -> DataFrame:
    """A folder of the index, or what lies below it by a pattern; no rows if it is absent."""
    try:
        return spark.read.schema(ddl).option("basePath", root).parquet(f"{root}{below}")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], ddl)
        raise


def _write(df: DataFrame, path: str, by: Sequence[str], mode: str | None = None) -> None:
    writer = df.write.mode("overwrite").partitionBy(*by)
    writer.option("partitionOverwriteMode", mode or "dynamic").parquet(path)


def load_folder(spark: SparkSession, load: str) -> str:
    """The folder name of a load, with Spark's escapes for odd characters."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{LOAD_COL}={names.escapePathName(load)}"


def read_load(spark: SparkSession, bronze: str, load: str) -> DataFrame:
    """The Bronze rows of one load, listing only its folders."""
    return _read(
        spark, bronze, f"{BRONZE_DDL}, {LOAD_COL} STRING", f"/{DATE_COL}=*/{load_folder(spark, load)}"
    )


def keys_of(rows: DataFrame) -> DataFrame:
    """The different ids and dates, with their loads, of the Bronze rows that can reach
    Silver, sorted by bucket and id. One shuffle by bucket serves all of it."""
    valid = rows.where(~any_null(CRITICAL_COLS))
    dated = valid.select(
        "event_id", F.col(DATE_COL).alias("bronze_date"), silver_date().alias("silver_date"),
        LOAD_COL, bucket_of().alias("bucket"),
    )
    return dated.repartition("bucket").distinct().sortWithinPartitions("bucket", "event_id")


def keys_in(spark: SparkSession, bronze: str, buckets: Sequence[int]) -> DataFrame:
    """The index rows of some buckets, by a filter on their folders."""
    if not buckets:
        return spark.createDataFrame([], KEYS_DDL)
    whole = _read(spark, f"{bronze}/{KEYS}", KEYS_DDL)
    return whole.where(F.col("bucket").isin(list(buckets)))


def keys_of_load(spark: SparkSession, bronze: str, load: str) -> DataFrame:
    return _read(spark, f"{bronze}/{KEYS}", KEYS_DDL, f"/bucket=*/{load_folder(spark, load)}")


def strays(spark: SparkSession, bronze: str) -> DataFrame:
    """``event_id, bronze_date, silver_date`` of the ids that lie on several dates."""
    return _read(spark, f"{bronze}/{STRAYS}", STRAYS_DDL).drop(LOAD_COL).distinct()


def _scattered_ids(keys: DataFrame) -> DataFrame:
    """The ids with more than one pair of dates, or whose two dates differ; of these, the ones
    with a row that is ``_mine``.

    One shuffle, and buffers of five numbers for each id, whatever its number of copies.
    """
    # A number below those of all dates stands for null.
    day = {c: F.coalesce(F.unix_date(c), F.lit(-(2**31))) for c in ("bronze_date", "silver_date")}
    ends = [f(n).alias(f"{c}_{f.__name__}") for c, n in day.items() for f in (F.min, F.max)]
    several = "bronze_date_min < bronze_date_max OR silver_date_min < silver_date_max"
    odd = f"{several} OR bronze_date_min <> silver_date_min"
    found = keys.groupBy("event_id").agg(F.max("_mine").alias("_mine"), *ends)
    return found.where(f"_mine AND ({odd})").select("event_id")


def _write_strays(keys: DataFrame, bronze: str, name: str, mode: str | None = None) -> None:
    """Stores the dates of the scattered ids among ``keys``. The ids are few, as a rule, so that
    their rows are found by a second look at the keys without a shuffle."""
    ids = cache_if_reused(_scattered_ids(keys))
    try:
        ids.count()
        found = keys.join(ids, "event_id", "left_semi").select(*column_names(KEY_DDL)).distinct()
        _write(found.withColumn(LOAD_COL, F.lit(name)), f"{bronze}/{STRAYS}", [LOAD_COL], mode)
    finally:
        ids.unpersist()


def index_load(spark: SparkSession, bronze: str, load: str) -> None:
    """Adds a stored load to the index.

    Older copies of its ids are looked up in the buckets that the load touches: at most
    ``BUCKETS`` numbers pass through the driver.
    """
    fresh = keys_of(read_load(spark, bronze, load))
    seen = Observation()
    observed = fresh.observe(seen, F.collect_set(F.col("bucket").cast("string")).alias("buckets"))
    _write(observed, f"{bronze}/{KEYS}", ["bucket", LOAD_COL])
    touched = sorted(map(int, seen.get["buckets"]))
    mine = keys_of_load(spark, bronze, load)
    others = keys_in(spark, bronze, touched).where(F.col(LOAD_COL) != load)
    both = mine.withColumn("_mine", F.lit(True)).unionByName(others.withColumn("_mine", F.lit(False)))
    _write_strays(both, bronze, load)


def index_bronze(spark: SparkSession, bronze: str) -> None:
    """Makes the index of a whole Bronze table anew, e.g. of one that other tools wrote."""
    rows = _read(spark, bronze, f"{BRONZE_DDL}, {LOAD_COL} STRING")
    keys_of(rows).write.mode("overwrite").partitionBy("bucket", LOAD_COL).parquet(f"{bronze}/{KEYS}")
    keys = _read(spark, f"{bronze}/{KEYS}", KEYS_DDL)
    _write_strays(keys.withColumn("_mine", F.lit(True)), bronze, "all", "static")


def fold_loads(spark: SparkSession, bronze: str, loads: Sequence[str], name: str) -> None:
    """Copies the index rows of some loads under one name; the old folders may then go."""
    if not loads:
        return
    named = F.col(LOAD_COL).isin(list(loads))
    keys = _read(spark, f"{bronze}/{KEYS}", KEYS_DDL).where(named)
    keys = keys.withColumn(LOAD_COL, F.lit(name)).repartition("bucket").distinct()
    _write(keys.sortWithinPartitions("bucket", "event_id"), f"{bronze}/{KEYS}", ["bucket", LOAD_COL])
    odd = _read(spark, f"{bronze}/{STRAYS}", STRAYS_DDL).where(named)
    odd = odd.withColumn(LOAD_COL, F.lit(name)).distinct()
    _write(odd, f"{bronze}/{STRAYS}", [LOAD_COL])


def copies_of(spark: SparkSession, bronze: str, ids: DataFrame) -> DataFrame:
    """The dates of all copies of the given ids, where they lie on several dates.

    The ids, which may be very many, meet the few scattered ones first.
    """
    odd = strays(spark, bronze)
    met = ids.select("event_id").join(odd.select("event_id"), "event_id", "left_semi")
    return odd.join(met.distinct(), "event_id", "left_semi")
