import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from runnel.operators import sessions
from runnel.plans.sizing import HotKeys, hot_keys
from tests.helpers import BASE, multiset, rows, silver

NONE_HOT, ALL_HOT = HotKeys([], False), HotKeys([], True)
SOME_HOT = HotKeys(["u1"], False)
PLANS = [NONE_HOT, ALL_HOT, SOME_HOT]


def brute_force(events, timeout=1800):
    """Session number and previous time per event, by a plain loop."""
    out, last = {}, {}
    for event_id, user, at, *_ in sorted(events, key=lambda e: (e[2], e[0])):
        sec = int((at - dt.datetime(1970, 1, 1)).total_seconds() // 1)
        prev = last.get(user)
        number = prev[1] if prev else 0
        if prev is None or sec - prev[0] > timeout:
            number += 1
        out[event_id] = (number, prev[2] if prev else None)
        last[user] = (sec, number, at)
    return out


def random_events(seed, n=300, users=("u1", "u2", "u3")):
    rng = random.Random(seed)
    steps = [0, 0, 0.25, 1, 59, 60, 1799, 1800, 1800.5, 1801, 2400, 7200, 40000]
    clock = {u: BASE for u in users}
    events = []
    for i in range(n):
        user = "u1" if rng.random() < 0.4 else rng.choice(users)
        clock[user] += dt.timedelta(seconds=rng.choice(steps))
        events.append((f"e{i:04d}", user, clock[user], {"endpoint": f"/{rng.randrange(4)}"}))
    rng.shuffle(events)
    return events


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


@pytest.fixture
def computed(spark):
    return F.lit(BASE).cast("timestamp_ntz")


@pytest.mark.parametrize("hot", PLANS)
def test_gap_limits(spark, hot):
    cases = {"29:59": 1799, "30:00": 1800, "30:00.5": 1800.5, "30:01": 1801}
    events = []
    for user, gap in cases.items():
        events += [(f"{user}-a", user, at(0)), (f"{user}-b", user, at(gap))]
    out = sessions.sessionize(silver(spark, *events), hot=hot)
    got = {r["user_id"]: r["session_num"] for r in out.collect() if r["event_id"].endswith("-b")}
    assert got == {"29:59": 1, "30:00": 1, "30:00.5": 1, "30:01": 2}


@pytest.mark.parametrize("hot", PLANS)
@pytest.mark.parametrize("seed", [1, 2])
def test_all_plans_equal_the_plain_loop(spark, hot, seed):
    events = random_events(seed)
    want = brute_force(events)
    df = silver(spark, *events)
    numbered = sessions.sessionize(df, hot=hot)
    assert {r["event_id"]: r["session_num"] for r in numbered.collect()} == {
        k: v[0] for k, v in want.items()
    }
    gaps = sessions.session_gaps(df, hot=hot)
    assert {r["event_id"]: r["prev_ts"] for r in gaps.collect()} == {
        k: v[1] for k, v in want.items()
    }
    new = {r["event_id"] for r in gaps.collect() if r["is_new_session"]}
    opened = {(u, want[e][0]) for e, u, *_ in events if e in new}
    assert len(new) == len(opened) == len({(u, want[e][0]) for e, u, *_ in events})


def test_summaries_of_all_plans_agree(spark, computed):
    df = silver(spark, *random_events(3))
    first, *others = [
        multiset(sessions.idle_sessions(df, computed, hot=hot)) for hot in PLANS
    ]
    assert first and all(o == first for o in others)
    named = sessions.session_summary(sessions.sessionize(df, hot=NONE_HOT), computed)
    assert multiset(named) == first


def test_one_user_with_a_third_of_all_rows_at_one_instant(spark):
    hot = [(f"h{i:04d}", "u1", at(0)) for i in range(200)]
    rest = [(f"c{i:04d}", f"c{i % 40}", at(i * 700)) for i in range(400)]
    df = silver(spark, *hot, *rest)
    found = hot_keys(df, "user_id", 100)
    assert found == HotKeys(["u1"], False)
    want = brute_force(hot + rest)
    out = sessions.sessionize(df, hot=found)
    assert {r["event_id"]: r["session_num"] for r in out.collect()} == {
        k: v[0] for k, v in want.items()
    }
    prev = sessions.session_gaps(df, hot=found)
    assert {r["event_id"]: r["prev_ts"] for r in prev.collect()} == {
        k: v[1] for k, v in want.items()
    }


def test_hot_plan_has_no_window_over_raw_rows(spark):
    df = silver(spark, *random_events(4))
    plan = sessions.sessionize(df, hot=ALL_HOT)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window") :]
    assert "Aggregate [user_id" in below and "_slice" in below


@pytest.mark.parametrize("hot", PLANS)
def test_rows_without_time_or_user_stay(spark, hot):
    df = silver(
        spark, ("a", "u1", None), ("b", "u1", at(0)), ("c", None, at(0)), ("d", None, at(4000))
    )
    out = sessions.sessionize(df, hot=hot)
    assert rows(out, "event_id", "session_num", "derived_session_id") == [
        ("a", None, None),
        ("b", 1, "u1_1"),
        ("c", 1, "1"),
        ("d", 2, "2"),
    ]
    assert sessions.idle_sessions(df, hot=hot).count() == 3


def test_hot_keys_include_null_and_become_a_table_beyond_the_limit(spark):
    df = silver(spark, *[(f"e{i}", None if i % 2 else "u", at(i)) for i in range(10)])
    assert set(hot_keys(df, "user_id", 4).values) == {None, "u"}
    assert hot_keys(df, "user_id", 5).none
    found = hot_keys(df, "user_id", 4, literals=1)
    assert not found.every and not found.none
    assert rows(found.table) == sorted([(None,), ("u",)], key=str)
    few, many = found.split(df.unionByName(silver(spark, ("x", "cold", at(0)))), "user_id")
    assert rows(few, "event_id") == [("x",)]
    assert many.count() == 10


@pytest.mark.parametrize("most", [200_000, 0])
def test_more_hot_users_than_literals(spark, monkeypatch, computed, most):
    """Hot users are split off by a broadcast or a shuffle join; the others keep the windows."""
    monkeypatch.setattr("runnel.plans.sizing.checked_broadcast.__defaults__", (most,))
    users = ("u1", "u2", "u3", "u4", "u5")
    events = random_events(7, 400, users)
    cold = [(f"z{i:02d}", f"cold{i % 9}", at(i * 900)) for i in range(40)]
    df = silver(spark, *events, *cold)
    found = hot_keys(df, "user_id", 20, literals=2)
    assert rows(found.table) == [(u,) for u in users]
    want = brute_force(events + cold)
    numbered = sessions.sessionize(df, hot=found)
    assert {r["event_id"]: r["session_num"] for r in numbered.collect()} == {
        k: v[0] for k, v in want.items()
    }
    gaps = sessions.session_gaps(df, hot=found)
    assert {r["event_id"]: r["prev_ts"] for r in gaps.collect()} == {
        k: v[1] for k, v in want.items()
    }
    summary = sessions.idle_sessions(df, computed, hot=found)
    assert multiset(summary) == multiset(sessions.idle_sessions(df, computed, hot=NONE_HOT))
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan



def test_summary_over_midnight_has_a_row_per_date(spark):
    late = dt.datetime(2024, 1, 10, 23, 50)
    df = silver(
        spark,
        ("a", "u1", late, {"endpoint": "/a", "is_error": True}),
        ("b", "u1", late + dt.timedelta(minutes=5), {"endpoint": "/b"}),
        ("c", "u1", late + dt.timedelta(minutes=15), {"endpoint": "/b", "latency_ms": 4.0}),
    )
    out = sessions.idle_sessions(df)
    assert rows(
        out,
        "derived_session_id",
        "event_date",
        "total_events",
        "session_duration_mins",
        "unique_endpoints",
        "errors_in_session",
        "avg_latency_ms",
        "region",
    ) == [
        ("u1_1", dt.date(2024, 1, 10), 2, 5.0, 2, 1, 1.0, "r-a"),
        ("u1_1", dt.date(2024, 1, 11), 1, 0.0, 1, 0, 4.0, "r-c"),
    ]


def test_client_sessions_group_by_the_given_id(spark):
    df = silver(
        spark,
        ("a", "u1", at(0), {"session_id": "s"}),
        ("b", "u1", at(9000), {"session_id": "s"}),
        ("c", "u1", at(9), {"session_id": None}),
    )
    out = sessions.session_summary_client(df)
    assert rows(out, "derived_session_id", "session_id", "session_duration_mins") == sorted(
        [("u1_s", "s", 150.0), (None, None, 0.0)], key=str
    )


@pytest.mark.parametrize("hot", PLANS)
def test_resumed_runs_equal_one_run(spark, computed, hot):
    events = random_events(5, n=90)
    df = silver(spark, *events)
    whole = sessions.resumable_sessions(df, computed_at=computed, hot=hot)
    days = sorted({e[2].date() for e in events})
    parts, before = [], None
    for day in days:
        today = df.where(df.event_date == day)
        if before is not None:
            before = before.where(before.event_date == day - dt.timedelta(days=1))
        got = sessions.resumable_sessions(today, before, computed, hot=hot)
        parts += multiset(got)
        before = spark.createDataFrame(got.collect(), got.schema)
    assert sorted(parts, key=str) == multiset(whole)


def test_user_partitioning_serves_the_summary(spark):
    df = silver(spark, *random_events(6))
    out = sessions.idle_sessions(df, hot=NONE_HOT)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == plan.count("Exchange ") == 1
