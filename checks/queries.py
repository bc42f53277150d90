"""The registered queries: each reads the given tables of ``sf_dir`` as a whole."""

from __future__ import annotations

import datetime as dt
import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (
    COMPUTED,
    INGESTED,
    LATE,
    LOADS,
    THIRD,
    bronze,
    customers,
    late_customers,
    logs_dup,
    logs_raw,
    ntz,
)
from runnel.functions.columns import status_category
from runnel.operators import gold, history, layout, quality, sessions, silver, upsert
from runnel.operators.mergeable import BITMAPS_DDL, RANK_ERROR, SKETCHES_DDL
from runnel.plans import dashboard, medallion
from runnel.plans.sizing import HotKeys, hot_keys, scratch_dir
from runnel.schemas import (
    BRONZE_DDL,
    DAILY_KPIS_DDL,
    KPI_KEYS,
    RAW_DDL,
    SESSION_KEYS,
    SESSIONS_DDL,
    SILVER_DDL,
    column_names,
    struct,
)
from runnel.sources import raw, tables, upkeep
from runnel.streaming import flows

AS_OF = dt.date(2024, 1, 30)
SPLIT = dt.date(2024, 1, 20)
WRONG = dt.date(2001, 1, 1)
KEY, COMPARED = "c_custkey", ["c_mktsegment", "c_acctbal"]
# Low enough for small tables to take the hot-user plan.
SKEWED_ROWS = 200

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="runnel-"))
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


# -- shared inputs ---------------------------------------------------------------------


def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean(bronze(spark, sf), tie_cols=["timestamp"])[0]


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    """Silver written once, for the queries that read it several times."""
    path = scratch_dir(spark, "silver")
    tables.write_table(clean_events(spark, sf), path)
    return tables.read_table(spark, path, SILVER_DDL)


def skewed(df: DataFrame) -> DataFrame:
    """A third of all events given to one user."""
    hot = F.substring("event_id", 5, 20).cast("bigint") % 3 == 0
    return df.withColumn("user_id", F.when(hot, "user_hot").otherwise(F.col("user_id")))


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_kpis(silver_table(spark, sf), ntz(COMPUTED), exact=True)


def hot_users(spark: SparkSession, sf: str) -> HotKeys:
    """Counted over the raw events, which takes one column and no cleaning."""
    return hot_keys(logs_raw(spark, sf), "user_id")


def skewed_users(spark: SparkSession, sf: str) -> HotKeys:
    return hot_keys(skewed(logs_raw(spark, sf)), "user_id", SKEWED_ROWS)


def idle(spark: SparkSession, sf: str) -> DataFrame:
    events = clean_events(spark, sf)
    return sessions.idle_sessions(events, ntz(COMPUTED), hot=hot_users(spark, sf))


def landed(spark: SparkSession, sf: str) -> str:
    path = scratch_dir(spark, "raw")
    logs_raw(spark, sf).write.json(path)
    return path


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The history after the first load, and the second snapshot."""
    first, second = customers(spark, sf)
    return history.scd2_stage(first, COMPARED, ntz(LOADS[0])), second


def applied(spark: SparkSession, sf: str) -> DataFrame:
    past, second = versions(spark, sf)
    return history.scd2_apply(past, second, KEY, COMPARED, ntz(LOADS[1]))


# -- scans, sources, sinks ---------------------------------------------------------------


@query
def bronze_ingest(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw.read_raw_logs(spark, landed(spark, sf))
    audited = silver.add_ingestion_metadata(rows, "landing", ntz(INGESTED))
    return silver.to_bronze(audited).drop("_corrupt_record")


@query
def bronze_sql_scan(spark: SparkSession, sf: str) -> DataFrame:
    raw.register_raw_logs(spark, landed(spark, sf), "landed_logs")
    return spark.table("landed_logs")


@query
def bronze_sample(spark: SparkSession, sf: str) -> DataFrame:
    return logs_raw(spark, sf).orderBy("event_id").limit(5)


@query
def land_partitioned_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "landing")
    raw.land_raw_logs(logs_raw(spark, sf), path, ntz(INGESTED))
    return raw.read_raw_logs(spark, path).drop("_corrupt_record")


@query
def silver_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return silver_table(spark, sf)


@query
def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    tag = uuid.uuid4().hex[:8]
    names = tables.create_tables(
        spark, scratch_dir(spark, "catalog"), [f"{n}_{tag}" for n in ("bronze", "silver", "gold")]
    )
    target = next(n for n in names if n.endswith("logs_cleaned"))
    columns = spark.table(target).columns
    clean_events(spark, sf).select(*columns).write.insertInto(target)
    return tables.row_counts(spark, names)


@query
def append_evolving(spark: SparkSession, sf: str) -> DataFrame:
    events = clean_events(spark, sf)
    old = events.where(F.col("event_date") <= F.lit(SPLIT)).drop("trace_id", "region")
    new = events.where(F.col("event_date") > F.lit(SPLIT))
    return upsert.append_evolving(old, new)


def wider_events(spark: SparkSession, sf: str) -> DataFrame:
    """Raw events read again from files with a text, an object and a mixed field more."""
    path = scratch_dir(spark, "raw")
    number = F.substring("event_id", 5, 20).cast("bigint")
    text = F.when(number % 4 == 1, F.lit('"high"')).otherwise(number.cast("string"))
    extra = {
        "canary": F.when(number % 5 == 0, F.lit("x")),
        "shard": F.struct(number.alias("n")),
        "level": F.parse_json(text),
    }
    logs_raw(spark, sf).withColumns(extra).write.json(path)
    return raw.read_raw_lines(spark, path)


@query
def bronze_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Types and counts of the fields of raw events that the data model lacks."""
    return raw.unknown_fields(wider_events(spark, sf))


@query
def bronze_promoted_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Two of these fields as columns; values that do not fit stay unknown."""
    kinds = {"shard": "struct<n: bigint>", "level": "bigint"}
    events = raw.promote_fields(wider_events(spark, sf), kinds)
    return events.select("event_id", F.col("shard.n").alias("shard"), "level", "_unknown_fields")


@query
def upsert_evolving(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table keeps the column that the upserted rows lack."""
    path = scratch_dir(spark, "kpis")
    old, new = overlapping(kpis(spark, sf), "total_requests")
    tables.upsert_table(spark, path, old.withColumn("note", F.lit("old")), KPI_KEYS)
    tables.upsert_table(spark, path, new, KPI_KEYS)
    return tables.read_table(spark, path, merge=True)


def late_arrivals(spark: SparkSession, sf: str) -> list[tuple[str, str, dt.date | None]]:
    """Raw files of two runs with their clocks; the second brings older events and corrected
    times."""
    number = F.substring("event_id", 5, 20).cast("bigint")
    corrected = (number % 40 == 11) & F.col("timestamp").isNotNull()
    wrong = F.when(number % 80 == 11, F.lit("unknown")).otherwise("2024-01-02T03:04:05.000Z")
    events = logs_raw(spark, sf)
    first = events.withColumn("timestamp", F.when(corrected, wrong).otherwise(F.col("timestamp")))
    arrivals = [first.where((number % 3 != 0) | corrected), events.where((number % 3 == 0) | corrected)]
    out = []
    for arrival, at, as_of in zip(arrivals, ("2024-01-31 00:00:00", INGESTED), (None, AS_OF)):
        out.append((scratch_dir(spark, "raw"), at, as_of))
        arrival.write.json(out[-1][0])
    return out


def late_flow(spark: SparkSession, sf: str, databases=None) -> medallion.Tables:
    """Two runs of the table flow."""
    root = scratch_dir(spark, "flow")
    for path, at, as_of in late_arrivals(spark, sf):
        target = medallion.run_tables(
            spark, path, root, as_of, at=ntz(at), exact=True, databases=databases
        )
    return target


@query
def silver_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the flow up to Silver."""
    target = medallion.Tables(scratch_dir(spark, "flow"))
    for path, at, as_of in late_arrivals(spark, sf):
        medallion.run_silver(spark, path, target, as_of, at=ntz(at))
    silver_now = tables.read_table(spark, target.silver, SILVER_DDL)
    return silver_now.drop("_source_file", "_ingested_at")


@query
def gold_late_events(spark: SparkSession, sf: str) -> DataFrame:
    path = late_flow(spark, sf).daily_kpis
    return tables.read_table(spark, path, DAILY_KPIS_DDL).drop("_computed_at")


@query
def flow_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the flow's tables, read through the catalog."""
    tag = uuid.uuid4().hex[:8]
    databases = [f"{n}_{tag}" for n in ("bronze", "silver", "gold")]
    late_flow(spark, sf, databases)
    names = ["raw_logs", "logs_cleaned", "daily_kpis"]
    owners = [*databases, databases[-1]]
    return tables.row_counts(spark, [f"{d}.{n}" for d, n in zip(owners, names)])


# -- projections, filters, quality -------------------------------------------------------


@query
def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_events(spark, sf)


@query
def silver_sql(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "silver")
    tables.write_table(
        silver.to_silver_sql(logs_raw(spark, sf), ntz(INGESTED)), path, "overwrite"
    )
    return tables.read_table(spark, path)


@query
def incremental_read(spark: SparkSession, sf: str) -> DataFrame:
    return silver.incremental(silver_table(spark, sf), AS_OF).select("event_id", "event_date")


@query
def status_classes(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("status_code")
    return logs_raw(spark, sf).select(
        "event_id", code, status_category(code).alias("status_category")
    )


QUERIES["status_category"] = QUERIES.pop("status_classes")


@query
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return gold.status_counts(clean_events(spark, sf))


@query
def dq_null_valid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_nulls(logs_raw(spark, sf))[0]


@query
def dq_null_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "quarantine")
    tables.write_quarantine(quality.split_nulls(logs_raw(spark, sf))[1], path)
    return tables.read_table(spark, path)


@query
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dedup_latest(logs_dup(spark, sf), ["event_id"], "ingest_seq", ["trace_id"])


@query
def dq_value_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.value_flags(logs_raw(spark, sf))
    return flagged.select("event_id", "status_code", "latency_ms", "_dq_flags")


@query
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dq_summary(logs_dup(spark, sf))


@query
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    text_code = F.when(F.col("status_code") == 999, "n/a").otherwise(
        F.col("status_code").cast("string")
    )
    changed = (
        logs_raw(spark, sf)
        .withColumn("status_code", text_code)
        .withColumn("tenant", F.nullif(F.col("region"), F.lit("us-east-1")))
        .drop("user_agent")
    )
    return quality.schema_drift(changed, struct(spark, RAW_DDL))


@query
def table_stats(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_stats(logs_raw(spark, sf), "raw_logs").drop("partitions")


# -- Gold ----------------------------------------------------------------------------------


@query
def daily_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return kpis(spark, sf)


@query
def daily_kpis_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """Exact indicators with a third of all events in one cell."""
    hot = F.substring("event_id", 5, 20).cast("bigint") % 3 == 0
    cell = {"event_date": F.lit(SPLIT), "service": F.lit("gateway"), "region": F.lit("us-east-1")}
    events = silver_table(spark, sf).withColumns(
        {c: F.when(hot, v).otherwise(F.col(c)) for c, v in cell.items()}
    )
    return gold.daily_kpis(events, ntz(COMPUTED), exact=True)


@query
def daily_kpis_approx(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_kpis(silver_table(spark, sf), ntz(COMPUTED), accuracy=1_000_000)


@query
def kpis_latest(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.latest_kpis(kpis(spark, sf))


@query
def session_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.session_gaps(clean_events(spark, sf), hot=hot_users(spark, sf)).select(
        "event_id", "user_id", "event_timestamp", "prev_ts", "gap_mins", "is_new_session"
    )


@query
def session_gaps_skewed(spark: SparkSession, sf: str) -> DataFrame:
    events = skewed(clean_events(spark, sf))
    return sessions.session_gaps(events, hot=skewed_users(spark, sf)).select(
        "event_id", "user_id", "event_timestamp", "prev_ts", "gap_mins", "is_new_session"
    )


@query
def sessionize(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.sessionize(clean_events(spark, sf), hot=hot_users(spark, sf)).select(
        "event_id", "user_id", "session_num", "derived_session_id"
    )


@query
def sessionize_skewed(spark: SparkSession, sf: str) -> DataFrame:
    events = skewed(clean_events(spark, sf))
    return sessions.sessionize(events, hot=skewed_users(spark, sf)).select(
        "event_id", "user_id", "session_num", "derived_session_id"
    )


@query
def sessions_idle(spark: SparkSession, sf: str) -> DataFrame:
    return idle(spark, sf)


@query
def sessions_idle_skewed(spark: SparkSession, sf: str) -> DataFrame:
    events = skewed(clean_events(spark, sf))
    return sessions.idle_sessions(events, ntz(COMPUTED), hot=skewed_users(spark, sf))


@query
def sessions_many_hot(spark: SparkSession, sf: str) -> DataFrame:
    """More hot users than a list of literals may hold; they are split off by a join."""
    events = clean_events(spark, sf)
    users = events.agg(F.count(F.lit(1)) / F.count_distinct("user_id")).first()[0]
    hot = hot_keys(events, "user_id", int(users), literals=2)
    return sessions.idle_sessions(events, ntz(COMPUTED), hot=hot)


@query
def sessions_client(spark: SparkSession, sf: str) -> DataFrame:
    events = silver.to_silver_sql(logs_raw(spark, sf), ntz(INGESTED))
    return sessions.session_summary_client(events, ntz(COMPUTED))


@query
def sessions_longest(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.longest_sessions(idle(spark, sf))


@query
def sessions_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs, the second taking up the sessions that the first left open."""
    path = scratch_dir(spark, "sessions")
    events = silver_table(spark, sf)
    early = events.where(F.col("event_date") <= F.lit(SPLIT))
    tables.replace_dates(sessions.resumable_sessions(early, None, ntz(COMPUTED)), path)
    first = SPLIT + dt.timedelta(days=1)
    before = medallion.session_rows_before(spark, path, first)
    late = events.where(F.col("event_date") >= F.lit(first))
    tables.replace_dates(sessions.resumable_sessions(late, before, ntz(COMPUTED)), path)
    return tables.read_table(spark, path, SESSIONS_DDL)


# -- dashboard: each report takes only the indicators it shows ---------------------------


@query
def kpi_error_trend(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.error_trend(gold.kpi_totals(clean_events(spark, sf)))


@query
def kpi_latency_by_service(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.latency_by_service(kpis(spark, sf))


@query
def kpi_daily_active(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.daily_active(gold.kpi_uniques(clean_events(spark, sf)))


def merged_cells(spark: SparkSession, sf: str) -> medallion.Tables:
    """The mergeable Gold tables after two runs, the second with some dates again."""
    target = medallion.Tables(scratch_dir(spark, "tables"))
    events = silver_table(spark, sf)
    tables.write_table(events.where(F.col("event_date") <= F.lit(SPLIT)), target.silver)
    medallion.refresh_mergeable(spark, target)
    later = events.where(F.col("event_date") > F.lit(SPLIT))
    tables.write_table(later, target.silver)
    days = [r[0] for r in later.select("event_date").distinct().collect()]
    medallion.refresh_mergeable(spark, target, [SPLIT, *days])
    return target


@query
def daily_active_exact(spark: SparkSession, sf: str) -> DataFrame:
    path = merged_cells(spark, sf).bitmaps
    return dashboard.daily_active_exact(tables.read_table(spark, path, BITMAPS_DDL))


@query
def latency_tails(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the merged percentiles of each service lie within the stated error of rank."""
    target = merged_cells(spark, sf)
    tails = dashboard.latency_tails(tables.read_table(spark, target.sketches, SKETCHES_DDL))
    values = tables.read_table(spark, target.silver, SILVER_DDL).select("service", "latency_ms")
    met = values.where("latency_ms IS NOT NULL").join(tails, "service")
    checks = []
    for name, p in gold.LATENCY_PROBS.items():
        below = F.count_if(F.col("latency_ms") < F.col(name)) / F.count(F.lit(1))
        upto = F.count_if(F.col("latency_ms") <= F.col(name)) / F.count(F.lit(1))
        near = (below <= p + RANK_ERROR) & (upto >= p - RANK_ERROR)
        checks.append(near.alias(name.replace("_latency_ms", "_within")))
    return met.groupBy("service", "n").agg(*checks)


@query
def kpi_top_endpoints(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_endpoints(clean_events(spark, sf))


@query
def kpi_region_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.region_traffic(gold.kpi_totals(clean_events(spark, sf)))


@query
def kpi_error_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.error_heatmap(clean_events(spark, sf))


@query
def kpi_session_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.session_buckets(idle(spark, sf))


@query
def kpi_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.summary_counters(gold.kpi_counts(silver_table(spark, sf)))


@query
def pipeline_health(spark: SparkSession, sf: str) -> DataFrame:
    events = silver_table(spark, sf)
    return dashboard.pipeline_health(
        {
            "bronze.raw_logs": (bronze(spark, sf), "_ingested_at"),
            "silver.logs_cleaned": (events, "_ingested_at"),
            "gold.daily_kpis": (gold.daily_kpis(events, ntz(COMPUTED)), "_computed_at"),
            "gold.session_summary": (
                sessions.idle_sessions(events, ntz(COMPUTED)),
                "_computed_at",
            ),
        }
    )


@query
def sql_tables_health(spark: SparkSession, sf: str) -> DataFrame:
    """The SQL-only table flow, from raw files to its health check."""
    target = medallion.Tables(scratch_dir(spark, "tables"))
    raw.register_raw_logs(spark, landed(spark, sf), "raw_view")
    medallion.rebuild_from_view(spark, "raw_view", target, ntz(COMPUTED))
    at = {"_ingested_at": ntz(COMPUTED)}
    return dashboard.pipeline_health(
        {
            "bronze.raw_logs": (spark.table("raw_view").withColumns(at), "_ingested_at"),
            "silver.logs_cleaned": (tables.read_table(spark, target.silver), "_ingested_at"),
            "gold.daily_kpis": (tables.read_table(spark, target.daily_kpis), "_computed_at"),
            "gold.session_summary": (tables.read_table(spark, target.sessions), "_computed_at"),
        }
    )


# -- upserts and history -----------------------------------------------------------------------


def overlapping(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """An older part whose overlap is out of date, and a newer part."""
    overlap = F.col("event_date") >= F.lit(SPLIT - dt.timedelta(days=1))
    stale = F.when(overlap, F.col(column) * 2).otherwise(F.col(column))
    old = df.where(F.col("event_date") <= F.lit(SPLIT)).withColumn(column, stale)
    return old, df.where(overlap)


@query
def kpis_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "kpis")
    for part in overlapping(kpis(spark, sf), "total_requests"):
        tables.upsert_table(spark, path, part, KPI_KEYS)
    return tables.read_table(spark, path, DAILY_KPIS_DDL)


@query
def sessions_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = overlapping(idle(spark, sf), "total_events")
    return upsert.upsert(old, new, SESSION_KEYS)


@query
def scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    return versions(spark, sf)[0]


@query
def scd2_checksum(spark: SparkSession, sf: str) -> DataFrame:
    second = customers(spark, sf)[1]
    return history.scd2_stage(second, COMPARED, ntz(LOADS[1])).select(KEY, "_checksum")


@query
def scd2_expire(spark: SparkSession, sf: str) -> DataFrame:
    past, second = versions(spark, sf)
    return history.scd2_expire(past, second, KEY, COMPARED, ntz(LOADS[1]))


@query
def scd2_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    past, second = versions(spark, sf)
    staged = history.scd2_stage(second, COMPARED, ntz(LOADS[1]))
    return history.scd2_new_rows(past, staged, KEY)


@query
def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    return applied(spark, sf)


@query
def scd2_table(spark: SparkSession, sf: str) -> DataFrame:
    """Both loads applied to a stored history."""
    path = scratch_dir(spark, "history")
    for snapshot, at in zip(customers(spark, sf), LOADS, strict=True):
        tables.upsert_history(spark, path, snapshot, KEY, COMPARED, ntz(at))
    return tables.read_history(spark, path)


@query
def scd2_version(spark: SparkSession, sf: str) -> DataFrame:
    """What the second of three loads left; the third came half a second later."""
    path = scratch_dir(spark, "history")
    first, second = customers(spark, sf)
    third = first.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    times = [*LOADS, LOADS[1].replace(":00:00", ":00:00.500")]
    for snapshot, at in zip((first, second, third), times, strict=True):
        tables.upsert_history(spark, path, snapshot, KEY, COMPARED, ntz(at))
    return tables.read_version(spark, path, 1).select(KEY, *COMPARED)


@query
def scd2_late_load(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads in order, then two whose times lie between them."""
    path = scratch_dir(spark, "history")
    first, second = customers(spark, sf)
    for snapshot, at in zip((first, second, first), (*LOADS, THIRD), strict=True):
        tables.upsert_history(spark, path, snapshot, KEY, COMPARED, ntz(at))
    for at in LATE:
        late = late_customers(spark, sf)
        tables.splice_history(spark, path, late, KEY, COMPARED, ntz(at))
    return tables.read_history(spark, path)


@query
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return history.current_rows(applied(spark, sf))


@query
def history_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return history.history_as_of(applied(spark, sf), ts=ntz("2024-01-15 12:00:00"))


@query
def history_as_of_version(spark: SparkSession, sf: str) -> DataFrame:
    return history.history_as_of(applied(spark, sf), version=1)


@query
def history_prune(spark: SparkSession, sf: str) -> DataFrame:
    return history.history_prune(applied(spark, sf), ntz("2024-02-20 00:00:00"))


@query
def compact_zorder(spark: SparkSession, sf: str) -> DataFrame:
    source, target = scratch_dir(spark, "silver"), scratch_dir(spark, "clustered")
    tables.write_table(clean_events(spark, sf), source)
    tables.compact_table(spark, source, target, ["event_date", "user_id"], files=8)
    return tables.read_table(spark, target, SILVER_DDL)


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """Silver along a Hilbert curve, with Bloom filters for users and events."""
    source, target = scratch_dir(spark, "silver"), scratch_dir(spark, "clustered")
    tables.write_table(clean_events(spark, sf), source)
    tables.compact_table(
        spark, source, target, ["event_date", "user_id"], files=6, curve="hilbert",
        lookup_cols=["event_id", "user_id"],
    )
    return tables.read_table(spark, target, SILVER_DDL)


@query
def compact_hilbert(spark: SparkSession, sf: str) -> DataFrame:
    return clustered(spark, sf)


@query
def events_of_users(spark: SparkSession, sf: str) -> DataFrame:
    """All events of the first three users, by a filter that the Bloom filters serve."""
    events = clustered(spark, sf)
    first = events.select("user_id").distinct().orderBy("user_id").limit(3).collect()
    return events.where(F.col("user_id").isin([r[0] for r in first]))


@query
def silver_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per date of a rebalanced Silver."""
    spread = layout.repartition_by_date(clean_events(spark, sf))
    return spread.groupBy("event_date").agg(F.count(F.lit(1)).alias("cnt"))


# -- streaming -----------------------------------------------------------------------------------


@query
def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    out, state = scratch_dir(spark, "bronze"), scratch_dir(spark, "state")
    flows.stream_bronze(spark, landed(spark, sf), out, state, ntz(INGESTED)).awaitTermination()
    rows = tables.read_table(spark, out, BRONZE_DDL)
    return rows.select(*column_names(RAW_DDL), "_ingested_at", "event_date")


@query
def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Some events with other times, then all events, then a second arrival of some of them."""
    src, out = scratch_dir(spark, "raw"), scratch_dir(spark, "bronze")
    target = medallion.Tables(scratch_dir(spark, "tables"))
    states = [scratch_dir(spark, "state") for _ in range(2)]
    events = logs_raw(spark, sf)
    copies = logs_dup(spark, sf).where("ingest_seq = 2").drop("ingest_seq")
    kept = F.substring("event_id", 5, 20).cast("bigint") % 10 == 3
    year = F.regexp_replace("timestamp", "^[0-9]{4}", "2001")
    moved = events.where(kept).withColumn("timestamp", year)
    for arrival, at in ((moved, "2024-01-01 00:00:00"), (events, INGESTED), (copies, INGESTED)):
        arrival.write.mode("append").json(src)
        flows.stream_bronze(spark, src, out, states[0], ntz(at)).awaitTermination()
        flows.stream_silver(
            spark, out, target.silver, target.quarantine, states[1]
        ).awaitTermination()
    return tables.read_table(spark, target.silver, SILVER_DDL).drop("_source_file")


def many_loads(
    spark: SparkSession, sf: str, upkeep_after: tuple[int, ...], follow: bool = False
) -> medallion.Tables:
    """Six loads by stream, after some of which the small files of Bronze are merged; with
    ``follow`` a stream to Silver after every second one."""
    target, src = medallion.Tables(scratch_dir(spark, "tables")), scratch_dir(spark, "raw")
    states = [scratch_dir(spark, "state") for _ in range(2)]
    number = F.substring("event_id", 5, 20).cast("bigint")
    for part in range(6):
        logs_raw(spark, sf).where(number % 6 == part).write.mode("append").json(src)
        flows.stream_bronze(spark, src, target.bronze, states[0], ntz(INGESTED)).awaitTermination()
        if part in upkeep_after:
            upkeep.merge_loads(spark, target.bronze)
        if follow and part % 2:
            flows.stream_silver(
                spark, target.bronze, target.silver, target.quarantine, states[1]
            ).awaitTermination()
    return target


@query
def bronze_upkeep(spark: SparkSession, sf: str) -> DataFrame:
    target = many_loads(spark, sf, (2, 5))
    rows = tables.read_table(spark, target.bronze, BRONZE_DDL)
    return rows.select(*column_names(RAW_DDL), "_ingested_at", "event_date")


@query
def silver_after_upkeep(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of a stream that meets merged files before and after it took their rows."""
    target = many_loads(spark, sf, (2, 3), follow=True)
    return tables.read_table(spark, target.silver, SILVER_DDL).drop("_source_file")


@query
def files_after_upkeep(spark: SparkSession, sf: str) -> DataFrame:
    """Files and rows of each date of Bronze."""
    target = many_loads(spark, sf, (2, 5))
    files = upkeep.stored_files(spark, target.bronze).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("files")
    )
    rows = tables.read_table(spark, target.bronze, BRONZE_DDL).groupBy(F.col("event_date").alias("day"))
    counted = rows.agg(F.count(F.lit(1)).alias("cnt"))
    both = files.join(counted, F.col("event_date").eqNullSafe(F.col("day")))
    return both.select("event_date", "files", "cnt")


@query
def stream_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality counts of two arrivals, the second with copies of events of the first."""
    src, out = scratch_dir(spark, "raw"), scratch_dir(spark, "bronze")
    target, noted = medallion.Tables(scratch_dir(spark, "tables")), scratch_dir(spark, "quality")
    states = [scratch_dir(spark, "state") for _ in range(2)]
    for first in (True, False):
        arrival = logs_dup(spark, sf).where((F.col("ingest_seq") == 1) == first)
        arrival.drop("ingest_seq").write.mode("append").json(src)
        flows.stream_bronze(spark, src, out, states[0], ntz(INGESTED)).awaitTermination()
        flows.stream_silver(
            spark, out, target.silver, target.quarantine, states[1], quality=noted
        ).awaitTermination()
    return flows.quality_so_far(spark, noted, target.silver)


@query
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rejects of two streams, each with a checkpoint of its own."""
    target = medallion.Tables(scratch_dir(spark, "tables"))
    number = F.substring("event_id", 5, 20).cast("bigint")
    for part in (0, 1):
        src, out = scratch_dir(spark, "raw"), scratch_dir(spark, "bronze")
        logs_raw(spark, sf).where(number % 2 == part).write.json(src)
        states = [scratch_dir(spark, "state") for _ in range(2)]
        flows.stream_bronze(spark, src, out, states[0], ntz(INGESTED)).awaitTermination()
        flows.stream_silver(
            spark, out, target.silver, target.quarantine, states[1]
        ).awaitTermination()
    held = tables.read_table(spark, target.quarantine)
    return held.select(*column_names(RAW_DDL), "_dq_reason", "_dq_null_cols")


def streamed_gold(spark: SparkSession, sf: str) -> medallion.Tables:
    """Gold after two arrivals that share a date.

    Some events of the second have come with the first too, all at one wrong time on a date
    of its own, which the second arrival empties.
    """
    target = medallion.Tables(scratch_dir(spark, "tables"))
    state = scratch_dir(spark, "state")
    events = silver_table(spark, sf)
    early = (F.col("event_date") < F.lit(SPLIT)) | (
        (F.col("event_date") == F.lit(SPLIT)) & (F.col("event_hour") < 12)
    )
    number = F.substring("event_id", 5, 20).cast("bigint")
    wrong = {"event_timestamp": ntz("2001-01-01 12:00:00"), "event_date": F.lit(WRONG)}
    moved = events.where(~early & (number % 40 == 11)).withColumns(wrong)
    tables.write_table(events.where(early).unionByName(moved), target.silver)
    gold_stream = functools.partial(
        flows.stream_gold, spark, target.silver, target.daily_kpis, target.sessions, state,
        ntz(COMPUTED), exact=True,
    )
    gold_stream().awaitTermination()
    later = events.where(F.col("event_date") >= F.lit(SPLIT))
    dates = [r[0] for r in later.select("event_date").distinct().collect()]
    medallion.replace_silver(later, target.silver, [*dates, WRONG])
    gold_stream().awaitTermination()
    return target


@query
def stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    path = streamed_gold(spark, sf).daily_kpis
    return tables.read_table(spark, path, DAILY_KPIS_DDL)


@query
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    path = streamed_gold(spark, sf).sessions
    return tables.read_table(spark, path, SESSIONS_DDL)
