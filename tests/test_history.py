import random

import pytest
from pyspark.sql import functions as F

from runnel.functions.columns import row_checksum
from runnel.operators import history, upsert
from runnel.sources import tables
from tests.helpers import multiset, rows

DDL = "k int, a string, b double"
COLS = ["a", "b"]


def at(day):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz")


def load(spark, data):
    return spark.createDataFrame(data, DDL)


def test_checksum_tells_null_from_absent_and_empty(spark):
    data = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a", "", "b"), ("a|", "", "b")]
    df = spark.createDataFrame(data, "x string, y string, z string")
    assert df.select(row_checksum(["x", "y", "z"])).distinct().count() == len(data)


def test_apply_covers_all_kinds_of_change(spark):
    first = history.scd2_stage(
        load(spark, [(1, "x", 1.0), (2, "x", 1.0), (3, None, 1.0), (4, "x", 1.0), (5, "x", None)]),
        COLS,
        at(1),
    )
    second = load(
        spark, [(1, "x", 1.0), (2, "y", 1.0), (3, "x", 1.0), (4, None, 1.0), (6, "n", 2.0)]
    )
    out = history.scd2_apply(first, second, "k", COLS, at(2))
    assert rows(out, "k", "a", "is_current") == sorted(
        [
            (1, "x", True),
            (2, "x", False), (2, "y", True),
            (3, None, False), (3, "x", True),
            (4, "x", False), (4, None, True),
            (5, "x", True),
            (6, "n", True),
        ],
        key=str,
    )
    closed = out.where("NOT is_current")
    assert closed.where(F.col("effective_end_date") != at(2)).count() == 0
    again = history.scd2_apply(out, second, "k", COLS, at(3))
    assert multiset(again) == multiset(out)


def test_one_step_equals_expire_and_insert(spark):
    rng = random.Random(3)

    def snapshot():
        keys = rng.sample(range(60), 40)
        return load(
            spark, [(k, rng.choice(["x", "y", None]), rng.choice([1.0, None])) for k in keys]
        )

    past = history.scd2_stage(snapshot(), COLS, at(1))
    for day in (2, 3, 4):
        new = snapshot()
        staged = history.scd2_stage(new, COLS, at(day))
        expired = history.scd2_expire(past, new, "k", COLS, at(day))
        steps = expired.unionByName(history.scd2_new_rows(expired, staged, "k"))
        past = history.scd2_apply(past, new, "k", COLS, at(day))
        assert multiset(past) == multiset(steps)
        assert past.where("is_current").groupBy("k").count().where("count > 1").count() == 0


def test_as_of_reads_every_load_back(spark):
    loads = [
        [(1, "x", 1.0), (2, "x", 1.0)],
        [(1, "y", 1.0), (2, "x", 1.0)],
        [(1, "y", 1.0), (2, None, 1.0), (3, "n", None)],
    ]
    past = history.scd2_stage(load(spark, loads[0]), COLS, at(1))
    for i, data in enumerate(loads[1:], 2):
        past = history.scd2_apply(past, load(spark, data), "k", COLS, at(i))
    for i, data in enumerate(loads):
        want = multiset(load(spark, data))
        assert multiset(history.history_as_of(past, at(i + 1)).select("k", "a", "b")) == want
        assert multiset(history.history_as_of(past, version=i).select("k", "a", "b")) == want
    assert history.history_as_of(past, version=3).count() == 0
    with pytest.raises(ValueError, match="time or a version"):
        history.history_as_of(past)


def test_stored_history_equals_the_frames(spark, folder):
    rng = random.Random(9)
    snapshots = [
        load(spark, [(k, rng.choice(["x", None]), 1.0) for k in rng.sample(range(30), 20)])
        for _ in range(3)
    ]
    past = history.scd2_stage(snapshots[0], COLS, at(1))
    for day, new in enumerate(snapshots, 1):
        if day > 1:
            past = history.scd2_apply(past, new, "k", COLS, at(day))
        for _ in range(2):  # a repeated load changes nothing
            tables.upsert_history(spark, f"{folder}/h", new, "k", COLS, at(day))
        assert multiset(tables.read_history(spark, f"{folder}/h")) == multiset(past)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_loads_give_the_history_of_loads_in_order(spark, folder, seed):
    """Snapshots lack keys at random, so a key's next load is not always the next one."""
    rng = random.Random(seed)
    snapshots = {
        day: load(
            spark,
            [(k, rng.choice(["x", "y", None]), 1.0) for k in rng.sample(range(24), 12)],
        )
        for day in range(1, 7)
    }
    late = rng.sample(range(1, 7), 3)
    timely = [day for day in snapshots if day not in late]
    for days, path in ((list(snapshots), "ordered"), (timely, "h")):
        for day in days:
            tables.upsert_history(spark, f"{folder}/{path}", snapshots[day], "k", COLS, at(day))
    for _ in range(2):  # repeated late loads change nothing
        for day in late:
            tables.splice_history(spark, f"{folder}/h", snapshots[day], "k", COLS, at(day))
    want = multiset(tables.read_history(spark, f"{folder}/ordered"))
    assert multiset(tables.read_history(spark, f"{folder}/h")) == want
    numbers = [*timely, *late]
    for n, day in enumerate(numbers):
        then = tables.read_version(spark, f"{folder}/h", n)
        assert multiset(then) == multiset(tables.read_version(spark, f"{folder}/ordered", day - 1))
    # The table goes on as usual.
    for path in ("ordered", "h"):
        tables.upsert_history(spark, f"{folder}/{path}", snapshots[late[0]], "k", COLS, at(9))
    want = multiset(tables.read_history(spark, f"{folder}/ordered"))
    assert multiset(tables.read_history(spark, f"{folder}/h")) == want


def test_late_load_limits(spark, folder):
    path = f"{folder}/h"
    for day, value in ((1, "a"), (3, "b"), (20, "c")):
        tables.upsert_history(spark, path, load(spark, [(1, value, 1.0)]), "k", COLS, at(day))
    with pytest.raises(ValueError, match="another snapshot"):
        tables.splice_history(spark, path, load(spark, [(1, "z", 1.0)]), "k", COLS, at(3))
    with pytest.raises(ValueError, match="several rows"):
        twice = load(spark, [(1, "x", 1.0), (1, "y", 1.0)])
        tables.splice_history(spark, path, twice, "k", COLS, at(2))
    before = multiset(tables.read_history(spark, path))
    tables.splice_history(spark, path, load(spark, []), "k", COLS, at(2))
    assert multiset(tables.read_history(spark, path)) == before
    tables.prune_history(spark, path, at(21), hours=7 * 24)
    with pytest.raises(ValueError, match="dropped"):
        tables.splice_history(spark, path, load(spark, [(1, "z", 1.0)]), "k", COLS, at(2))


def test_prune_keeps_current_and_recently_closed(spark):
    past = history.scd2_stage(load(spark, [(1, "x", 1.0), (2, "x", 1.0)]), COLS, at(1))
    past = history.scd2_apply(past, load(spark, [(1, "y", 1.0)]), "k", COLS, at(2))
    past = history.scd2_apply(past, load(spark, [(2, "y", 1.0)]), "k", COLS, at(9))
    assert history.history_prune(past, at(9), 168).count() == 4
    assert rows(history.history_prune(past, at(10), 168), "k", "a") == [
        (1, "y"), (2, "x"), (2, "y"),
    ]


def test_upsert_is_idempotent_and_null_safe(spark):
    old = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([(None, 20), ("d", 40)], "k string, v int")
    once = upsert.upsert(old, new, ["k"])
    assert rows(once) == sorted([("a", 1), ("c", 3), (None, 20), ("d", 40)], key=str)
    assert multiset(upsert.upsert(once, new, ["k"])) == multiset(once)


def test_append_evolving_fills_missing_columns(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, b string")
    assert rows(upsert.append_evolving(old, new)) == [(1, None), (2, "x")]


def test_loads_in_one_second_keep_all_versions(spark, folder):
    def moment(text):
        return F.lit(f"2024-01-01 00:00:00.{text}").cast("timestamp_ntz")

    for text, value in (("100", "a"), ("500", "b"), ("900", "c")):
        tables.upsert_history(spark, f"{folder}/h", load(spark, [(1, value, 1.0)]), "k", COLS, moment(text))
    assert rows(tables.read_history(spark, f"{folder}/h"), "a") == [("a",), ("b",), ("c",)]
    for text, value in (("900", "d"), ("200", "d")):
        with pytest.raises(ValueError, match="later than every load"):
            tables.upsert_history(spark, f"{folder}/h", load(spark, [(1, value, 1.0)]), "k", COLS, moment(text))
    with pytest.raises(ValueError, match="several rows"):
        tables.upsert_history(
            spark, f"{folder}/h", load(spark, [(1, "x", 1.0), (1, "y", 1.0)]), "k", COLS, at(9)
        )


def test_load_numbers_outlive_pruning(spark, folder):
    def moment(day):
        return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz")

    path = f"{folder}/h"
    for day, value in ((1, "a"), (2, "b"), (2, "b"), (3, "b"), (20, "c"), (21, "d")):
        tables.upsert_history(spark, path, load(spark, [(1, value, 1.0)]), "k", COLS, moment(day))

    def values():
        out = []
        for n in range(5):
            try:
                out.append(rows(tables.read_version(spark, path, n), COLS[0]))
            except ValueError:
                out.append(None)
        return out

    assert values() == [[("a",)], [("b",)], [("b",)], [("c",)], [("d",)]]
    for _ in range(2):
        tables.prune_history(spark, path, moment(21), hours=7 * 24)
        assert values() == [None, [("b",)], [("b",)], [("c",)], [("d",)]]
    for wrong in (-1, 5):
        with pytest.raises(ValueError, match="no load"):
            tables.read_version(spark, path, wrong)
