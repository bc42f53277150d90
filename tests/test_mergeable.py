"""Bitmaps and sketches that are merged over cells."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.operators import mergeable
from runnel.plans import dashboard, medallion
from runnel.plans.medallion import Tables
from runnel.schemas import KPI_KEYS
from runnel.sources import tables
from tests.helpers import BASE, rows
from tests.helpers import silver as silver_rows

DAY = dt.timedelta(days=1)


def events():
    """Users who are on in two services on one date, and again on the next."""
    out = []
    for i in range(600):
        more = {"service": f"s{i % 3}", "region": f"r{i % 2}", "latency_ms": None if i % 50 == 0 else float(i)}
        out.append((f"e{i}", f"u{i * 7 % 90}", BASE + (i % 4) * DAY, more))
    return out


def test_users_of_two_cells_count_once(spark, folder):
    target = Tables(folder)
    whole = silver_rows(spark, *events())
    want = rows(whole.groupBy("event_date").agg(F.count_distinct("user_id").alias("n")), "event_date", "n")
    first = whole.where(F.col("event_date") < F.lit(BASE.date() + 2 * DAY))
    tables.write_table(first, target.silver)
    medallion.refresh_mergeable(spark, target)
    numbers = {r["key"]: r["number"] for r in tables.read_table(spark, target.numbers).collect()}
    tables.write_table(whole.join(first, "event_id", "left_anti"), target.silver)
    days = [BASE.date() + i * DAY for i in (1, 2, 3)]
    for _ in range(2):
        medallion.refresh_mergeable(spark, target, days)
    stored = tables.read_table(spark, target.numbers, mergeable.NUMBERS_DDL)
    users = stored.where("kind = 'user'")
    assert users.count() == users.select("key").distinct().count() == 90
    assert stored.count() == stored.select("kind", "number").distinct().count()
    # Numbers once given do not change.
    assert numbers.items() <= {r["key"]: r["number"] for r in stored.collect()}.items()
    bitmaps = tables.read_table(spark, target.bitmaps, mergeable.BITMAPS_DDL)
    exact = dashboard.daily_active_exact(bitmaps)
    assert rows(exact, "event_date", "daily_active_users") == want
    by_service = rows(
        mergeable.distinct_counts(bitmaps, ["service"]).where("kind = 'user'"), "service", "n"
    )
    assert by_service == rows(
        whole.groupBy("service").agg(F.count_distinct("user_id").alias("n")), "service", "n"
    )


def test_reports_read_gold_only(spark, folder):
    target = Tables(folder)
    tables.write_table(silver_rows(spark, *events()), target.silver)
    medallion.refresh_mergeable(spark, target)
    bitmaps = tables.read_table(spark, target.bitmaps, mergeable.BITMAPS_DDL)
    files = dashboard.daily_active_exact(bitmaps).inputFiles()
    assert files and all("/gold/active_bitmaps/" in f for f in files)


def test_keys_beyond_one_bitmap(spark):
    """More numbers than one bitmap has bits."""
    df = spark.range(70_000).select(
        F.lit(BASE.date()).alias("event_date"), F.lit("s").alias("service"), F.lit("r").alias("region"),
        F.concat(F.lit("u"), F.col("id") % 50_000).alias("user_id"),
    )
    known = spark.createDataFrame([], "key string, number bigint")
    numbers = mergeable.new_numbers(df.select("user_id"), known)
    assert numbers.select("number").distinct().count() == 50_000
    bitmaps = mergeable.cell_bitmaps(df, "user_id", numbers).withColumn("kind", F.lit("user"))
    assert bitmaps.count() > 1
    assert rows(mergeable.distinct_counts(bitmaps, ["event_date"]), "n") == [(50_000,)]


@pytest.mark.parametrize("by", [["service"], ["event_date", "region"], KPI_KEYS])
def test_merged_percentiles_keep_their_rank(spark, by):
    rng = np.random.default_rng(4)
    data = [
        (BASE.date() + int(i % 3) * DAY, f"s{i % 2}", f"r{i % 5}", float(x))
        for i, x in enumerate(rng.lognormal(4.5, 0.8, 30_000))
    ]
    df = spark.createDataFrame(data, "event_date date, service string, region string, latency_ms double")
    merged = mergeable.merged_percentiles(mergeable.cell_sketches(df), by, {"p95": 0.95, "p99": 0.99})
    values = {}
    for row in df.collect():
        values.setdefault(tuple(row[c] for c in by), []).append(row["latency_ms"])
    for row in merged.collect():
        group = np.array(values[tuple(row[c] for c in by)])
        assert row["n"] == len(group)
        for name, p in (("p95", 0.95), ("p99", 0.99)):
            assert (group < row[name]).mean() <= p + mergeable.RANK_ERROR
            assert (group <= row[name]).mean() >= p - mergeable.RANK_ERROR


def test_cell_without_values(spark):
    df = silver_rows(spark, ("e", "u", BASE, {"service": "s", "region": "r", "latency_ms": None}))
    found = dashboard.latency_tails(mergeable.cell_sketches(df)).collect()
    assert [(r["n"], r["p95_latency_ms"]) for r in found] == [(0, None)]
