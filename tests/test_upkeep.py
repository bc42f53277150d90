"""Upkeep of Bronze: merged files hold the same rows, and nothing that follows changes."""

import json

import pytest
from pyspark.sql import functions as F

from runnel.plans.medallion import Tables, bronze_for, load_bronze, refresh_silver, touched_dates
from runnel.schemas import BRONZE_DDL, SILVER_DDL
from runnel.sources import keyindex, upkeep
from runnel.sources.tables import create_tables, publish_tables, read_table
from runnel.streaming import flows
from tests.helpers import BASE, multiset, raw_row
from tests.test_tables import DAY, events, write_lines


@pytest.fixture
def at():
    return F.lit(BASE).cast("timestamp_ntz")


def loaded(spark, tmp_path, folder, at, n=6):
    """Loads over three dates and one without a time; a copy of an event on another date."""
    target = Tables(f"{folder}/tables")
    moved = dict(events(1)[0], timestamp=(BASE + 2 * DAY).isoformat() + ".000Z")
    for i in range(n):
        batch = [dict(e, event_id=f"{e['event_id']}-{i}") for e in events(6, days=3)]
        batch += [raw_row(f"bad-{i}", user_id=None), raw_row(f"undated-{i}", timestamp="no")]
        batch += [dict(moved, event_id=f"{moved['event_id']}-0")] if i == n - 1 else []
        write_lines(tmp_path / f"raw{i}", [json.dumps(e) for e in batch])
        load_bronze(spark, str(tmp_path / f"raw{i}"), target, at, f"load {i}+%")
    return target


def files_by_date(spark, target):
    counted = upkeep.stored_files(spark, target.bronze).groupBy("event_date").count()
    return {r["event_date"]: r["count"] for r in counted.collect()}


def test_merged_loads_hold_the_same_rows(spark, tmp_path, folder, at):
    target = loaded(spark, tmp_path, folder, at)
    before = multiset(read_table(spark, target.bronze, BRONZE_DDL))
    refresh_silver(spark, target)
    held = {p: multiset(read_table(spark, p)) for p in (target.silver, target.quarantine)}
    odd = multiset(keyindex.strays(spark, target.bronze))
    assert len(odd) == 2
    assert min(files_by_date(spark, target).values()) >= 6
    assert upkeep.merge_loads(spark, target.bronze) >= 24
    assert set(files_by_date(spark, target).values()) == {1}
    assert multiset(read_table(spark, target.bronze, BRONZE_DDL)) == before
    assert upkeep.merge_loads(spark, target.bronze) == 0
    # A repeated load is known by its name, though its folders are gone.
    load_bronze(spark, str(tmp_path / "raw0"), target, at, "load 0+%")
    assert multiset(read_table(spark, target.bronze, BRONZE_DDL)) == before
    assert touched_dates(spark, target.bronze, "load 0+%") == []
    # The index knows the copies of the merged loads, and batch runs know their files.
    assert multiset(keyindex.strays(spark, target.bronze)) == odd
    rows_, _ = bronze_for(spark, target.bronze, [BASE.date()])
    assert rows_.where("event_date <> DATE '2024-01-10'").count() == 1
    for dates in ([BASE.date(), None], None):
        refresh_silver(spark, target, dates)
        assert {p: multiset(read_table(spark, p)) for p in held} == held
    # New loads are merged with the file that is there.
    load_bronze(spark, str(tmp_path / "raw1"), target, at, "later")
    assert upkeep.merge_loads(spark, target.bronze) > 0
    assert set(files_by_date(spark, target).values()) == {1}
    assert read_table(spark, target.bronze, BRONZE_DDL).count() == len(before) + 8


def test_bins_follow_from_sizes(spark):
    sizes = [("d1", 30)] * 10 + [("d1", 60), ("d1", 500), ("d2", 10), ("d3", 5), ("d3", 5)]
    rows_ = [(f"p{i}", "a", f"f{i:02}", n, d) for i, (d, n) in enumerate(sizes)]
    files = spark.createDataFrame(rows_, "path string, _load string, file string, bytes long, d string")
    days = F.to_date(F.replace("d", F.lit("d"), F.lit("2024-01-0")))
    planned = upkeep.plan_bins(files.withColumn("event_date", days).drop("d"), 100).collect()
    bins = {}
    for r in planned:
        bins.setdefault((r["event_date"].day, r["bin"]), []).append(r["path"])
    assert bins == {
        (1, 0): ["p0", "p1", "p2", "p3"], (1, 1): ["p4", "p5", "p6"], (1, 2): ["p7", "p8", "p9"],
        (3, 0): ["p13", "p14"],
    }


def test_rounds_are_bounded(spark, tmp_path, folder, at):
    target = loaded(spark, tmp_path, folder, at, 4)
    before = multiset(read_table(spark, target.bronze, BRONZE_DDL))
    upkeep.merge_loads(spark, target.bronze, round_files=3)
    assert set(files_by_date(spark, target).values()) == {1}
    assert multiset(read_table(spark, target.bronze, BRONZE_DDL)) == before


@pytest.mark.parametrize("broken", ["staged", "half", "moved"])
def test_rounds_that_broke_off(spark, tmp_path, folder, at, broken, monkeypatch):
    target = loaded(spark, tmp_path, folder, at, 3)
    before = multiset(read_table(spark, target.bronze, BRONZE_DDL))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(upkeep, "delete_folders" if broken == "moved" else "_finish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            upkeep.merge_loads(spark, target.bronze)
    if broken == "half":
        run = next((tmp_path / "tables/bronze/raw_logs/_merging").iterdir())
        (run / "rows/_SUCCESS").unlink()
    held = read_table(spark, target.bronze, BRONZE_DDL).count()
    assert held == (2 if broken == "moved" else 1) * len(before)
    upkeep.merge_loads(spark, target.bronze)
    assert set(files_by_date(spark, target).values()) == {1}
    assert multiset(read_table(spark, target.bronze, BRONZE_DDL)) == before
    assert list((tmp_path / "tables/bronze/raw_logs/_merging").iterdir()) == []


def test_catalog_follows(spark, tmp_path, folder, at):
    names = [f"{n}_upkeep" for n in ("bronze", "silver", "gold")]
    created = create_tables(spark, f"{folder}/tables", names)
    target = loaded(spark, tmp_path, folder, at, 2)
    publish_tables(spark, created[:1])
    n = spark.table(created[0]).count()
    upkeep.merge_loads(spark, target.bronze, name=created[0])
    assert spark.table(created[0]).count() == n == 17
    for database in names:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_streams_take_merged_rows_once(spark, tmp_path, folder, at):
    target = loaded(spark, tmp_path, folder, at, 3)
    quality = f"{folder}/quality"

    def follow():
        flows.stream_silver(
            spark, target.bronze, target.silver, target.quarantine, f"{folder}/state", quality=quality
        ).awaitTermination()
        tables = (read_table(spark, target.silver, SILVER_DDL), read_table(spark, target.quarantine))
        return [multiset(t) for t in (*tables, flows.quality_so_far(spark, quality, target.silver))]

    first = follow()
    upkeep.merge_loads(spark, target.bronze)
    assert follow() == first
    # Files that the stream has never met come merged with those that it has.
    write_lines(tmp_path / "more", [json.dumps(raw_row("new")), json.dumps(raw_row("bad", user_id=None))])
    load_bronze(spark, str(tmp_path / "more"), target, at, "more")
    upkeep.merge_loads(spark, target.bronze)
    more = follow()
    assert [len(t) for t in more[:2]] == [len(first[0]) + 1, len(first[1]) + 1]
    total, valid, bad, copies = flows.quality_so_far(spark, quality, target.silver).select(
        "total_rows", "valid_rows", "quarantined_rows", "duplicates_removed"
    ).first()
    assert (total, valid, bad, copies) == (27, 23, 4, 1)


def test_without_loads(spark, folder):
    assert upkeep.merge_loads(spark, f"{folder}/none") == 0
