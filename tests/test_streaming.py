import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from runnel.operators.gold import daily_kpis
from runnel.operators.quality import dq_summary, quality_by_file
from runnel.operators.sessions import resumable_sessions
from runnel.operators.silver import clean
from runnel.plans.medallion import Tables, load_bronze, refresh_silver
from runnel.schemas import (
    BRONZE_DDL,
    DAILY_KPIS_DDL,
    DATE_COL,
    FILE_COL,
    QUARANTINE_DDL,
    SESSIONS_DDL,
    SILVER_DDL,
)
from runnel.sources.tables import read_table
from runnel.streaming import flows
from tests.helpers import BASE, multiset, raw_row, rows
from tests.test_tables import write_lines


def event(i, minutes, user="u1"):
    at = BASE + dt.timedelta(minutes=minutes)
    return raw_row(f"e{i}", user_id=user, timestamp=at.isoformat() + ".000Z", latency_ms=float(i))


def arrivals():
    night = 14 * 60 + 50  # 23:50 on the first date
    first = [event(i, 20 * i) for i in range(10)] + [raw_row("bad", user_id=None)]
    second = [event(10, night), event(11, night + 20), event(12, night + 45), event(3, 60)]
    late = [event(13, night + 10), event(14, 30, "u2"), event(11, night + 20)]
    return [first, second, late]


@pytest.fixture
def at():
    return F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")


def run(spark, tmp_path, folder, at):
    target = Tables(f"{folder}/tables")
    flows.stream_bronze(
        spark, f"{folder}/raw", target.bronze, f"{folder}/state/bronze", at
    ).awaitTermination()
    flows.stream_silver(
        spark, target.bronze, target.silver, target.quarantine, f"{folder}/state/silver"
    ).awaitTermination()
    flows.stream_gold(
        spark,
        target.silver,
        target.daily_kpis,
        target.sessions,
        f"{folder}/state/gold",
        at,
        exact=True,
    ).awaitTermination()
    return target


def test_stream_equals_batch_after_every_arrival(spark, tmp_path, folder, at):
    for batch in arrivals():
        write_lines(tmp_path / "raw", [json.dumps(e) for e in batch])
        target = run(spark, tmp_path, folder, at)
        bronze = read_table(spark, target.bronze, BRONZE_DDL)
        silver, rejected = clean(bronze)
        held = read_table(spark, target.silver, SILVER_DDL)
        assert multiset(held.drop("_source_file")) == multiset(silver.drop("_source_file"))
        assert rejected.count() == read_table(spark, target.quarantine).count()
        kpis = read_table(spark, target.daily_kpis, DAILY_KPIS_DDL)
        assert multiset(kpis) == multiset(daily_kpis(held, at, exact=True))
        sessions = read_table(spark, target.sessions, SESSIONS_DDL)
        assert multiset(sessions) == multiset(resumable_sessions(held, computed_at=at))
    over_midnight = sessions.groupBy("derived_session_id").count().where("count > 1")
    assert over_midnight.count() == 1
    nothing_new = run(spark, tmp_path, folder, at)
    assert read_table(spark, nothing_new.silver, SILVER_DDL).count() == 15


def test_quality_of_streams_equals_the_whole(spark, tmp_path, folder, at, monkeypatch):
    """Also if a batch is repeated after its counts were noted, or a date lacks its time."""
    target, noted = Tables(f"{folder}/tables"), f"{folder}/quality"
    repeated = []

    def twice(batch):
        repeated.append(quality_by_file(batch))
        return repeated[-1].union(repeated[-1])

    monkeypatch.setattr(flows, "quality_by_file", twice)
    undated = {**raw_row("when"), "timestamp": "no time"}
    for batch in [*arrivals(), [undated, undated, raw_row(None)]]:
        write_lines(tmp_path / "raw", [json.dumps(e) for e in batch])
        flows.stream_bronze(
            spark, f"{folder}/raw", target.bronze, f"{folder}/state/bronze", at
        ).awaitTermination()
        flows.stream_silver(
            spark,
            target.bronze,
            target.silver,
            target.quarantine,
            f"{folder}/state/silver",
            quality=noted,
        ).awaitTermination()
        whole = dq_summary(read_table(spark, target.bronze, BRONZE_DDL))
        assert rows(flows.quality_so_far(spark, noted, target.silver)) == rows(whole)
    assert len(repeated) == 4 and rows(whole)[0][1:] == (19, 2, 3)


@pytest.mark.parametrize("most", [0, 5_000])
def test_rejects_of_one_load_on_two_dates(spark, folder, monkeypatch, most):
    """Files of one load share a name; its dates may come in different batches."""
    monkeypatch.setattr("runnel.sources.tables.MAX_DATES", most)
    dates = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, dt.date(2024, 1, 2)]
    for date in dates:
        row = spark.createDataFrame([(date, "part-0")], f"{DATE_COL} date, {FILE_COL} string")
        empty = spark.createDataFrame([], QUARANTINE_DDL)
        rejected = empty.unionByName(row, allowMissingColumns=True)
        flows.add_to_quarantine(rejected, f"{folder}/quarantine")
    held = read_table(spark, f"{folder}/quarantine", QUARANTINE_DDL)
    assert multiset(held.select(DATE_COL)) == multiset(
        spark.createDataFrame([(d,) for d in dates[:3]], f"{DATE_COL} date")
    )


def bronze_batch(spark, target):
    whole = read_table(spark, target.bronze, BRONZE_DDL)
    return whole.withColumn(FILE_COL, F.col("_metadata.file_name"))


def test_repeated_batch_adds_nothing(spark, tmp_path, folder, at):
    write_lines(tmp_path / "raw", [json.dumps(e) for b in arrivals() for e in b])
    target = run(spark, tmp_path, folder, at)
    counts = []
    for _ in range(2):
        batch = bronze_batch(spark, target)
        flows.add_to_silver(batch, target.bronze, target.silver, target.quarantine)
        counts.append(
            (
                read_table(spark, target.silver, SILVER_DDL).count(),
                read_table(spark, target.quarantine).count(),
            )
        )
    assert counts == [(15, 1), (15, 1)]


def test_moved_copies_empty_their_dates(spark, tmp_path, folder, at):
    """The only event of a date moves to another one, which goes on from its session."""
    other = [event(7, 2880 + 5, "u2"), event(8, 2880 + 1439, "u3"), event(9, 2880 + 1445, "u3")]
    for minutes, more in ((0, other), (1500, []), (30, [event(8, 2880 + 600, "u3")])):
        write_lines(tmp_path / "raw", [json.dumps(e) for e in [event(1, minutes), *more]])
        clock = F.lit(dt.datetime(2024, 2, 1) + dt.timedelta(minutes=minutes)).cast("timestamp_ntz")
        target = run(spark, tmp_path, folder, clock)
        held = read_table(spark, target.silver, SILVER_DDL)
        kpis = read_table(spark, target.daily_kpis, DAILY_KPIS_DDL).drop("_computed_at")
        assert multiset(kpis) == multiset(daily_kpis(held, exact=True).drop("_computed_at"))
        sessions = read_table(spark, target.sessions, SESSIONS_DDL).drop("_computed_at")
        assert multiset(sessions) == multiset(resumable_sessions(held).drop("_computed_at"))


@pytest.mark.parametrize("most", [5000, 0])
def test_copy_with_another_time_by_default(spark, tmp_path, folder, monkeypatch, most):
    monkeypatch.setattr("runnel.sources.tables.MAX_DATES", most)
    for i, minutes in enumerate((0, 3000)):
        clock = F.lit(dt.datetime(2024, 2, 1 + i)).cast("timestamp_ntz")
        write_lines(tmp_path / "raw", [json.dumps(event(1, minutes)), json.dumps(event(2 + i, 5000))])
        target = Tables(f"{folder}/tables")
        flows.stream_bronze(
            spark, f"{folder}/raw", target.bronze, f"{folder}/state/bronze", clock
        ).awaitTermination()
        flows.stream_silver(
            spark, target.bronze, target.silver, target.quarantine, f"{folder}/state/silver"
        ).awaitTermination()
    held = read_table(spark, target.silver, SILVER_DDL)
    assert rows(held, "event_id") == [("e1",), ("e2",), ("e3",)]
    assert held.where("event_id = 'e1'").first()["event_date"] == BASE.date() + dt.timedelta(2)


def test_backlog_is_cut_into_batches(spark, tmp_path, folder):
    for batch in arrivals():
        write_lines(tmp_path / "raw", [json.dumps(e) for e in batch])
    query = flows.stream_bronze(
        spark, f"{folder}/raw", f"{folder}/bronze", f"{folder}/state", max_bytes=1
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert read_table(spark, f"{folder}/bronze", BRONZE_DDL).count() == 18


def test_changed_copy_replaces_the_earlier_one(spark, tmp_path, folder):
    for i, code in enumerate((200, 503)):
        clock = F.lit(dt.datetime(2024, 2, 1 + i)).cast("timestamp_ntz")
        write_lines(tmp_path / "raw", [json.dumps(dict(event(1, 0), status_code=code))])
        target = run(spark, tmp_path, folder, clock)
    assert rows(read_table(spark, target.silver, SILVER_DDL), "status_code") == [(503,)]


def test_loads_and_streams_share_bronze_and_quarantine(spark, tmp_path, folder, at):
    write_lines(tmp_path / "raw", [json.dumps(event(1, 0)), json.dumps(raw_row("bad", user_id=None))])
    target = run(spark, tmp_path, folder, at)
    more = [event(2, 5), raw_row("worse", user_id=None)]
    write_lines(tmp_path / "more", [json.dumps(e) for e in more])
    load_bronze(spark, str(tmp_path / "more"), target, at)
    assert read_table(spark, target.bronze, BRONZE_DDL).count() == 4
    run(spark, tmp_path, folder, at)
    assert rows(read_table(spark, target.silver, SILVER_DDL), "event_id") == [("e1",), ("e2",)]
    assert rows(read_table(spark, target.quarantine), "event_id") == [("bad",), ("worse",)]
    # Another stream over the same files does not double their rejects.
    flows.stream_silver(
        spark, target.bronze, target.silver, target.quarantine, f"{folder}/state/other"
    ).awaitTermination()
    assert rows(read_table(spark, target.quarantine), "event_id") == [("bad",), ("worse",)]
    # The batch flow replaces whole dates, whoever wrote them.
    refresh_silver(spark, target, [BASE.date()])
    assert rows(read_table(spark, target.quarantine), "event_id") == [("bad",), ("worse",)]
    assert rows(read_table(spark, target.silver, SILVER_DDL), "event_id") == [("e1",), ("e2",)]


def test_batch_is_told_apart_by_one_shuffle(spark, tmp_path, folder, at, monkeypatch):
    """Copies within a batch and those in Silver meet in the same window."""
    write_lines(tmp_path / "raw", [json.dumps(e) for b in arrivals() for e in b])
    target = run(spark, tmp_path, folder, at)
    before = multiset(read_table(spark, target.silver, SILVER_DDL))
    plans, replace = [], flows.replace_silver

    def seen(df, *others):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        replace(df, *others)

    monkeypatch.setattr(flows, "replace_silver", seen)
    flows.add_to_silver(bronze_batch(spark, target), target.bronze, target.silver, target.quarantine)
    assert [p.count("row_number() windowspec") for p in plans] == [1]
    assert multiset(read_table(spark, target.silver, SILVER_DDL)) == before
