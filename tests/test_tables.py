import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from runnel.operators import layout, silver
from runnel.operators.sessions import resumable_sessions, stale_users
from runnel.plans import medallion
from runnel.plans.medallion import (
    Tables,
    refresh_gold,
    refresh_sessions,
    refresh_silver,
    run_tables,
)
from runnel.plans.sizing import checked_broadcast, scratch_dir
from runnel.schemas import (
    BRONZE_DDL,
    DAILY_KPIS_DDL,
    KPI_KEYS,
    SESSIONS_DDL,
    SILVER_DDL,
    column_names,
)
from runnel.sources import keyindex, raw, tables
from tests.helpers import BASE, multiset, raw_row, rows
from tests.helpers import silver as silver_rows

DAY = dt.timedelta(days=1)


def write_lines(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.json").write_text("\n".join(lines) + "\n")


def events(n, start=0, days=5):
    return [
        raw_row(
            f"e{i}",
            user_id=f"u{i % 4}",
            timestamp=(BASE + (i % days) * DAY + dt.timedelta(minutes=i)).isoformat() + ".000Z",
            latency_ms=float(i),
        )
        for i in range(start, start + n)
    ]


def test_broken_line_is_kept_with_its_text(spark, tmp_path):
    lines = [json.dumps(raw_row("ok")), '{"event_id": "cut', '{"event_id":"x","status_code":"n/a"}']
    write_lines(tmp_path / "raw", lines)
    df = raw.read_raw_logs(spark, str(tmp_path / "raw"))
    typed = silver.to_bronze(silver.add_ingestion_metadata(df)).drop("_ingested_at")
    lines_df = raw.read_raw_lines(spark, str(tmp_path / "raw"))
    out = silver.to_bronze(lines_df.withColumn("_ingested_at", F.localtimestamp()))
    assert multiset(out.select(*typed.columns)) == multiset(typed)
    assert sorted(out.columns) == sorted(column_names(BRONZE_DDL))
    kept = {(r["event_id"], r["_corrupt_record"]) for r in out.collect()}
    assert kept == {("ok", None), (None, lines[1]), ("x", lines[2])}
    files = {r[0].rsplit("/", 1)[-1] for r in rows(out, "_source_file")}
    assert files == {"part-0.json"}
    assert silver.clean(out)[1].count() == 2


def test_unknown_fields_are_kept_and_counted(spark, tmp_path, folder):
    known = json.dumps(raw_row("plain"))
    more = [dict(raw_row("a"), zone="z1", tags={"k": [1, 2]}), dict(raw_row("b"), zone=None)]
    write_lines(tmp_path / "raw", [known, "", "   ", *map(json.dumps, more)])
    target = Tables(f"{folder}/tables")
    medallion.load_bronze(spark, str(tmp_path / "raw"), target)
    bronze = tables.read_table(spark, target.bronze, BRONZE_DDL)
    kept = {r["event_id"]: json.loads(r["_unknown_fields"] or "{}") for r in bronze.collect()}
    assert kept["plain"] == {} and kept["a"] == {"zone": "z1", "tags": {"k": [1, 2]}}
    want = [("zone", "STRING", 1), ("tags", "OBJECT<k: ARRAY<BIGINT>>", 1)]
    assert multiset(raw.unknown_fields(bronze)) == multiset(
        spark.createDataFrame(want, "column string, kind string, non_null long")
    )


def parsed(spark, *lines):
    return raw.parse_raw_lines(spark.createDataFrame([(v,) for v in lines], "value string"))


def test_types_of_unknown_fields(spark):
    lines = [
        '{"event_id":"a","n":1,"mixed":1,"o":{"p":[1],"q":"s"},"none":null,"it\'s":true}',
        '{"event_id":"b","n":2.5,"mixed":"t","o":{"p":[1.5]}}',
        '{"event_id":"c","twice":{"k":1,"k":2},"n":3}',
        "{broken",
    ]
    bronze = parsed(spark, *lines)
    found = {r["column"]: (r["kind"], r["non_null"]) for r in raw.unknown_fields(bronze).collect()}
    assert found == {
        "n": ("VARIANT", 3), "mixed": ("VARIANT", 2), "none": ("VOID", 0), "it's": ("BOOLEAN", 1),
        "o": ("OBJECT<p: ARRAY<DECIMAL(21,1)>, q: STRING>", 2), "twice": ("STRING", 1),
    }
    kept = {r["event_id"]: r["_unknown_fields"] for r in bronze.collect()}
    assert json.loads(kept["c"]) == {"twice": '{"k":1,"k":2}', "n": "3"} and kept[None] is None
    assert raw.unknown_fields(parsed(spark)).count() == 0


def test_promoted_fields_lose_nothing(spark):
    bronze = parsed(
        spark,
        '{"event_id":"a","n":7,"s":"x","o":{"p":1},"rest":[1]}',
        '{"event_id":"b","n":2.5,"s":5,"o":{"p":1,"q":2}}',
        '{"event_id":"c","n":"no","s":null,"o":{}}',
        '{"event_id":"d"}',
        '{"event_id":"e","n":123456789012345678901234567890}',
    )
    kinds = {"n": "BIGINT", "s": "string", "o": "struct<p: int>"}
    out = raw.promote_fields(bronze, kinds)
    got = {r["event_id"]: (r["n"], r["s"], r["o"] and r["o"]["p"]) for r in out.collect()}
    left = {r["event_id"]: json.loads(r["_unknown_fields"] or "{}") for r in out.collect()}
    assert got == {
        "a": (7, "x", 1), "b": (None, "5", None), "c": (None, None, None),
        "d": (None, None, None), "e": (None, None, None),
    }
    assert left == {
        "a": {"rest": [1]}, "b": {"n": 2.5, "o": {"p": 1, "q": 2}}, "c": {"n": "no"}, "d": {},
        "e": {"n": 123456789012345678901234567890},
    }
    assert dict(out.dtypes)["n"] == "bigint" and out.columns[-3:] == ["n", "s", "o"]
    with pytest.raises(ValueError, match="event_id"):
        raw.promote_fields(bronze, {"event_id": "string"})


def test_repeated_load_replaces_itself(spark, tmp_path, folder):
    write_lines(tmp_path / "raw", [json.dumps(e) for e in events(6)])
    target = Tables(f"{folder}/tables")
    for load in ("a", "a", "b", None):
        medallion.load_bronze(spark, str(tmp_path / "raw"), target, load=load)
    assert tables.read_table(spark, target.bronze, BRONZE_DDL).count() == 18
    counts = refresh_silver(spark, target)
    assert counts == {
        "total_rows": 18, "valid_rows": 18, "quarantined_rows": 0, "duplicates_removed": 12,
    }
    some = refresh_silver(spark, target, [BASE.date()])
    assert (some["total_rows"], some["duplicates_removed"]) == (6, 4)


def test_sql_view_reads_the_same_rows(spark, tmp_path):
    write_lines(tmp_path / "raw", [json.dumps(e) for e in events(5)])
    raw.register_raw_logs(spark, str(tmp_path / "raw"), "raw_view")
    want = raw.read_raw_logs(spark, str(tmp_path / "raw")).drop("_corrupt_record")
    assert multiset(spark.table("raw_view")) == multiset(want)


def test_landing_folders(spark, tmp_path, folder):
    write_lines(tmp_path / "raw", [json.dumps(e) for e in events(3)])
    df = raw.read_raw_logs(spark, str(tmp_path / "raw")).drop("_corrupt_record")
    raw.land_raw_logs(df, f"{folder}/landing", F.lit(dt.date(2024, 3, 5)))
    assert (tmp_path / "landing/year=2024/month=03/day=05").is_dir()
    back = raw.read_raw_logs(spark, f"{folder}/landing")
    assert rows(back, "year", "month", "day") == [(2024, 3, 5)] * 3
    assert multiset(back.select(df.columns)) == multiset(df)


def test_upsert_table_rewrites_touched_dates_only(spark, tmp_path, folder):
    path = f"{folder}/t"

    def cells(*rows_):
        return spark.createDataFrame(rows_, "event_date date, service string, region string, n int")

    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    tables.upsert_table(
        spark, path, cells((d[0], "a", "r", 1), (d[1], "a", "r", 2), (d[1], "b", "r", 3)), KPI_KEYS
    )
    untouched = sorted(p.name for p in (tmp_path / "t/event_date=2024-01-01").iterdir())
    change = cells((d[1], "a", "r", 20), (d[2], "c", "r", 4))
    for _ in range(2):
        tables.upsert_table(spark, path, change, KPI_KEYS)
        assert rows(tables.read_table(spark, path), "event_date", "service", "n") == [
            (d[0], "a", 1),
            (d[1], "a", 20),
            (d[1], "b", 3),
            (d[2], "c", 4),
        ]
    assert untouched == sorted(p.name for p in (tmp_path / "t/event_date=2024-01-01").iterdir())


def test_read_dates_prunes_and_tolerates_absence(spark, folder):
    df = silver_rows(spark, *[(f"e{i}", "u", BASE + i * DAY) for i in range(4)], ("n", "u", None))
    assert tables.read_dates(spark, f"{folder}/none", [BASE.date()], SILVER_DDL).count() == 0
    tables.write_table(df, f"{folder}/t")
    got = tables.read_dates(spark, f"{folder}/t", [BASE.date(), dt.date(1999, 1, 1)], SILVER_DDL)
    assert rows(got, "event_id", "event_date") == [("e0", BASE.date())]
    got = tables.read_dates(spark, f"{folder}/t", [None], SILVER_DDL)
    assert rows(got, "event_id", "event_date") == [("n", None)]
    plan = silver.incremental(
        tables.read_table(spark, f"{folder}/t", SILVER_DDL), BASE.date() + DAY
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text


def test_read_dates_of_falls_back_to_a_join(spark, folder, monkeypatch):
    df = silver_rows(spark, *[(f"e{i}", "u", BASE + i * DAY) for i in range(4)], ("n", "u", None))
    tables.write_table(df, f"{folder}/t")
    some = df.where("event_id IN ('e1', 'e2', 'n')")
    want = [("e1",), ("e2",), ("n",)]
    got = tables.read_dates_of(spark, f"{folder}/t", some, SILVER_DDL)
    assert rows(got, "event_id") == want
    monkeypatch.setattr(tables, "MAX_DATES", 1)
    got = tables.read_dates_of(spark, f"{folder}/t", some, SILVER_DDL)
    assert rows(got, "event_id") == want


def test_quarantine_append(spark, folder):
    df = spark.createDataFrame([(1, "x")], "a int, _dq_reason string")
    tables.write_quarantine(df, f"{folder}/q")
    tables.write_quarantine(df.limit(0), f"{folder}/q")
    assert tables.read_table(spark, f"{folder}/q").count() == 1


def test_evolving_append_on_disk(spark, folder):
    tables.write_table(spark.createDataFrame([(1,)], "a int"), f"{folder}/t", partition_cols=())
    tables.write_table(
        spark.createDataFrame([(2, "x")], "a int, b string"), f"{folder}/t", partition_cols=()
    )
    assert rows(tables.read_table(spark, f"{folder}/t", merge=True)) == [(1, None), (2, "x")]
    assert rows(tables.read_table(spark, f"{folder}/t", "a int, b string")) == [(1, None), (2, "x")]


def test_declared_tables(spark, folder):
    names = ["t_bronze", "t_silver", "t_gold"]
    found = tables.create_tables(spark, folder, names)
    assert found == tables.create_tables(spark, folder, names)
    for name, ddl in zip(
        found,
        [f"{BRONZE_DDL}, _load STRING", SILVER_DDL, DAILY_KPIS_DDL, SESSIONS_DDL],
        strict=True,
    ):
        table = spark.table(name)
        assert sorted(table.columns) == sorted(column_names(ddl))
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        assert parts == ["event_date", *(["_load"] if "_load" in table.columns else [])]
    assert rows(tables.row_counts(spark, found))[0] == ("daily_kpis", 0)
    for name in names:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_repartition_by_date_splits_a_large_date(spark):
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    df = spark.range(0, 300_000, 1, 16).select(
        F.lit(dt.date(2024, 1, 1)).alias("event_date"), F.xxhash64("id").alias("v"), "id"
    )
    df = df.withColumn("event_date", F.when(F.col("id") < 0, None).otherwise(F.col("event_date")))
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spread = layout.repartition_by_date(df)
        numbered = spread.withColumn("p", F.spark_partition_id())
        parts = numbered.groupBy("p").agg(F.max("v"), F.max("id"))
        assert len(parts.collect()) > 8
        assert spread.count() == 300_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cache_if_reused(spark):
    df = spark.range(3).select("id")
    assert not layout.cache_if_reused(df, 1).is_cached
    assert layout.cache_if_reused(df).is_cached
    df.unpersist()


@pytest.mark.parametrize("cols", [None, ["event_date", "user_id"], ["latency_ms", "endpoint"]])
@pytest.mark.parametrize("files", [None, 4])
def test_compaction_keeps_every_row(spark, cols, files):
    data = [
        (f"e{i}", f"user_{i % 37}", BASE + i % 9 * DAY, {"latency_ms": None if i % 5 else i * 1.5})
        for i in range(400)
    ]
    df = silver_rows(spark, *data)
    assert multiset(layout.compact(df, cols, files)) == multiset(df)


def test_clustering_narrows_both_columns(spark):
    df = spark.range(20_000).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 64 AS INT)) AS event_date",
        "concat('user_', lpad(CAST(pmod(xxhash64(id), 64) AS STRING), 3, '0')) AS user_id",
    )
    out = layout.compact(df, ["event_date", "user_id"], 16)
    spans = (
        out.withColumn("p", F.spark_partition_id())
        .groupBy("p")
        .agg(F.count_distinct("event_date").alias("d"), F.count_distinct("user_id").alias("u"))
        .collect()
    )
    assert len(spans) == 16
    assert max(r["d"] for r in spans) <= 32 and max(r["u"] for r in spans) <= 32


def test_hilbert_places_are_neighbours(spark):
    bits = 4
    grid = spark.range(256).selectExpr("id % 16 AS x", "id DIV 16 AS y")
    found = grid.select("x", "y", layout.hilbert_place(F.col("x"), F.col("y"), bits).alias("d"))
    line = [(r["x"], r["y"]) for r in found.orderBy("d").collect()]
    assert sorted(r["d"] for r in found.collect()) == list(range(256))
    assert line[0] == (0, 0)
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(line, line[1:]))
    with pytest.raises(ValueError, match="two columns"):
        layout.compact(grid, ["x"], 2, "hilbert")


def test_hilbert_files_are_touched_less_often(spark):
    grid = spark.range(64 * 64 * 4).selectExpr("id % 64 AS x", "id DIV 64 % 64 AS y", "id")
    touched = {}
    for curve in ("z", "hilbert"):
        out = layout.compact(grid, ["x", "y"], 24, curve)
        assert out.count() == grid.count()
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("x", "y") for f in (F.min, F.max)]
        boxes = out.groupBy(F.spark_partition_id()).agg(*ends).collect()
        touched[curve] = sum(
            r["min_x"] < x + 8 and x <= r["max_x"] and r["min_y"] < y + 8 and y <= r["max_y"]
            for r in boxes for x in range(0, 57, 3) for y in range(0, 57, 3)
        )
    assert touched["hilbert"] < touched["z"]


def test_point_reads_pass_over_row_groups(spark, folder):
    # Too many values for a dictionary, and unordered, so that only the Bloom filter can tell.
    ids = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("event_id"), "id")
    tables.write_table(ids, f"{folder}/ids", "overwrite", ())

    def scanned(path, value):
        found = spark.read.parquet(path).where(F.col("event_id") == value)
        n = len(found.collect())
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return n, leaf.metrics().apply("numOutputRows").value()

    for name, cols in (("plain", ()), ("looked", ("event_id",))):
        tables.compact_table(spark, f"{folder}/ids", f"{folder}/{name}", files=2, lookup_cols=cols)
    there = ids.first()[0]
    assert scanned(f"{folder}/plain", "7" * 64)[1] > 0
    assert scanned(f"{folder}/looked", "7" * 64) == (0, 0)
    found, rows_read = scanned(f"{folder}/looked", there)
    assert found == 1 and 0 < rows_read < scanned(f"{folder}/plain", there)[1]


def test_clustering_spreads_rows_that_agree(spark):
    df = spark.range(20_000).selectExpr("'one' AS user_id", "DATE '2024-01-01' AS event_date", "id")
    out = layout.compact(df, ["event_date", "user_id"], 8)
    sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 5_000


def test_checked_broadcast_has_another_way(spark):
    big = spark.range(1000).select("id")
    small = spark.range(10).select("id")
    hinted = big.join(checked_broadcast(small, 10), "id")
    plain = big.join(checked_broadcast(small, 9), "id")
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (hinted, plain)]
    assert ["rightHint=(strategy=broadcast)" in p for p in plans] == [True, False]
    assert hinted.count() == plain.count() == 10


def test_scratch_is_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first = scratch_dir(spark, "a")
    assert first != scratch_dir(spark, "a")
    if base:
        assert first.startswith(base)


def test_tables_flow_in_steps_equals_one_rebuild(spark, tmp_path, folder):
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    data = events(60) + [raw_row("bad", user_id=None), raw_row("odd", timestamp="later")]
    lines = [json.dumps(e) for e in data]
    write_lines(tmp_path / "raw", lines)
    whole = run_tables(spark, str(tmp_path / "raw"), f"{folder}/whole", at=at)
    last = BASE.date() + 4 * DAY

    # The last dates arrive late and some of them twice.
    early = [e for e in lines if json.loads(e)["timestamp"] < last.isoformat()]
    late = [e for e in lines if e not in early]
    write_lines(tmp_path / "early", early)
    write_lines(tmp_path / "late", late + late[:5])
    stepwise = f"{folder}/steps"
    run_tables(spark, str(tmp_path / "early"), stepwise, at=at)
    for _ in range(2):
        run_tables(spark, str(tmp_path / "late"), stepwise, as_of=last, at=at)
    steps = Tables(stepwise)
    pairs = [
        (whole.silver, steps.silver, SILVER_DDL),
        (whole.daily_kpis, steps.daily_kpis, DAILY_KPIS_DDL),
        (whole.sessions, steps.sessions, SESSIONS_DDL),
    ]
    for a, b, ddl in pairs:
        left = tables.read_table(spark, a, ddl).drop("_source_file")
        right = tables.read_table(spark, b, ddl).drop("_source_file")
        assert multiset(left) == multiset(right), ddl
    assert tables.read_table(spark, steps.silver, SILVER_DDL).count() == 61
    assert tables.read_table(spark, whole.quarantine).count() == 1

    before = multiset(tables.read_table(spark, steps.sessions, SESSIONS_DDL))
    refresh_silver(spark, steps)
    refresh_gold(spark, steps, computed_at=at)
    assert multiset(tables.read_table(spark, steps.sessions, SESSIONS_DDL)) == before


def test_late_events_recompute_only_what_changes(spark, folder, monkeypatch):
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    # u1 is active every 25 minutes for three days but for one hole; u2 now and then.
    every = [(f"a{i}", "u1", BASE + dt.timedelta(minutes=25 * i)) for i in range(170)]
    other = [(f"b{i}", "u2", BASE + dt.timedelta(hours=7 * i)) for i in range(17)]
    hole = every.pop(20)
    path, out = f"{folder}/silver", f"{folder}/sessions"

    def arrive(*new):
        tables.write_table(silver_rows(spark, *new), path)
        done = refresh_sessions(spark, path, out, {e[2].date() for e in new}, at)
        whole = resumable_sessions(tables.read_table(spark, path, SILVER_DDL), computed_at=at)
        assert multiset(tables.read_table(spark, out, SESSIONS_DDL)) == multiset(whole)
        return [(d - BASE.date()).days for d in done]

    assert arrive(*every, *other) == [0, 1, 2, 3, 4, 5]
    # Not near midnight and in a session of its own: the next dates stay as they are.
    assert arrive(("late", "u2", BASE + dt.timedelta(hours=3))) == [0]
    # Closes the hole: u1's session now has another first second on all its dates. The
    # first try breaks off after two of them.
    calls = []

    def break_off(*given):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return stale_users(*given)

    tables.write_table(silver_rows(spark, hole), path)
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "stale_users", break_off)
        with pytest.raises(RuntimeError, match="lost"):
            refresh_sessions(spark, path, out, [BASE.date()], at)
    assert refresh_sessions(spark, path, out, [BASE.date()], at) == [
        BASE.date() + i * DAY for i in (0, 1, 2, 3)
    ]
    assert arrive(("x", "u3", BASE + DAY), ("y", "u3", BASE + 4 * DAY)) == [1, 4]


def test_clustering_withstands_one_odd_value(spark):
    df = spark.range(20_001).selectExpr(
        "CASE WHEN id = 20000 THEN 'anonymous' ELSE concat('user_', lpad(CAST(id % 5000 AS STRING), 6, '0')) END AS user_id",
        "id",
    )
    z = layout.z_value(df, ["user_id"], 6)
    assert df.select(z.alias("z")).distinct().count() >= 60


@pytest.mark.parametrize("count", [0, 1, 2, 7, 8, 300])
def test_both_searches_find_the_same_bucket(spark, count):
    data = [(None,), (float("nan"),), *((i / 2,) for i in range(-3, 2 * count + 3))]
    df = spark.createDataFrame(data, "x double")
    bounds = [F.lit(float(i)) for i in range(count)]
    x = F.col("x")
    nested = F.when(x.isNull(), 0).otherwise(layout._bucket(x, bounds))
    found = df.select("x", layout._searched_bucket(x, bounds).alias("a"), nested.alias("b"))
    assert found.where("NOT a <=> b").count() == 0
    want = F.when(x.isNull(), 0).when(F.isnan(x), count)
    want = want.otherwise(F.least(F.greatest(F.floor(x) + 1, F.lit(0)), F.lit(count)))
    assert found.where(F.col("a") != want).count() == 0


def test_clustering_has_cells_for_very_many_files(spark):
    bits = layout.bucket_bits(200_000, 2)
    assert 2 ** (2 * bits) >= 4 * 200_000
    df = spark.range(200_000).selectExpr("xxhash64(id) AS a", "CAST(xxhash64(id, 1) AS STRING) AS b")
    cells = df.select(layout.z_value(df, ["a", "b"], bits).alias("z"))
    assert cells.distinct().count() > 100_000
    odd = spark.createDataFrame([(None, "x"), (None, None), (3, None)], "a long, b string")
    assert odd.select(layout.z_value(odd, ["a", "b"], bits)).count() == 3


def test_incremental_runs_lose_and_double_nothing(spark, tmp_path, folder):
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    later = F.lit(dt.datetime(2024, 2, 2)).cast("timestamp_ntz")
    last = BASE.date() + 4 * DAY
    first = events(60) + [raw_row("odd", timestamp="2024-01-05 10:00:00"), raw_row("bad", user_id=None)]
    moved = dict(first[3], timestamp=(BASE + dt.timedelta(days=2, hours=1)).isoformat() + ".000Z")
    old = raw_row("old", timestamp=(BASE - dt.timedelta(days=20)).isoformat() + ".000Z")
    second = [moved, old, raw_row("odd2", timestamp="later")]
    write_lines(tmp_path / "one", [json.dumps(e) for e in first])
    write_lines(tmp_path / "two", [json.dumps(e) for e in second])
    steps, whole = Tables(f"{folder}/steps"), Tables(f"{folder}/whole")
    run_tables(spark, str(tmp_path / "one"), steps.root, at=at)
    run_tables(spark, str(tmp_path / "two"), steps.root, as_of=last, at=later)
    medallion.load_bronze(spark, str(tmp_path / "one"), whole, at)
    medallion.load_bronze(spark, str(tmp_path / "two"), whole, later)
    refresh_silver(spark, whole)
    refresh_gold(spark, whole, computed_at=at)
    for a, b, ddl in [
        (whole.silver, steps.silver, SILVER_DDL),
        (whole.daily_kpis, steps.daily_kpis, DAILY_KPIS_DDL),
        (whole.sessions, steps.sessions, SESSIONS_DDL),
    ]:
        left, right = (tables.read_table(spark, p, ddl).drop("_computed_at") for p in (a, b))
        assert multiset(left) == multiset(right), ddl
    held = tables.read_table(spark, steps.silver, SILVER_DDL)
    assert held.count() == held.select("event_id").distinct().count() == 63
    assert tables.read_table(spark, steps.quarantine).count() == 1


def test_upsert_keeps_columns_and_rejects_double_keys(spark, folder):
    path = f"{folder}/t"
    old = spark.createDataFrame([("2024-01-01", 1, "x", "kept")], "d string, k int, v string, more string")
    old = old.selectExpr("CAST(d AS DATE) AS event_date", "k", "v", "more")
    new = old.select("event_date", F.lit(2).alias("k"), F.lit("y").alias("v"))
    for part in (old, new):
        tables.upsert_table(spark, path, part, ["event_date", "k"])
    found = tables.read_table(spark, path, merge=True)
    assert rows(found, "k", "v", "more") == [(1, "x", "kept"), (2, "y", None)]
    with pytest.raises(ValueError, match="several rows"):
        tables.upsert_table(spark, path, new.unionByName(new), ["event_date", "k"])


def files_of(df):
    """The dates whose files a frame reads, those of the index left out."""
    return {n.split("event_date=")[1].split("/")[0] for n in df.inputFiles() if "event_date=" in n}


def test_incremental_run_reads_touched_dates_only(spark, tmp_path, folder):
    """Copies on other dates are found by the index; other dates and buckets are not read."""
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    target = Tables(f"{folder}/tables")
    write_lines(tmp_path / "one", [json.dumps(e) for e in events(60, days=10)])
    medallion.load_bronze(spark, str(tmp_path / "one"), target, at, "one")
    assert keyindex.strays(spark, target.bronze).count() == 0
    moved = dict(events(1, 3)[0], timestamp=(BASE + 7 * DAY).isoformat() + ".000Z")
    write_lines(tmp_path / "two", [json.dumps(moved)])
    for _ in range(2):
        medallion.load_bronze(spark, str(tmp_path / "two"), target, at, "two")
        dates = medallion.touched_dates(spark, target.bronze, "two")
        assert sorted(dates) == [BASE.date() + 3 * DAY, BASE.date() + 7 * DAY]
        assert keyindex.strays(spark, target.bronze).count() == 2
    for asked in ([BASE.date() + 3 * DAY], [BASE.date() + 7 * DAY]):
        rows_, own = medallion.bronze_for(spark, target.bronze, asked)
        assert files_of(rows_) == {d.isoformat() for d in dates}
        later = asked == [BASE.date() + 7 * DAY]
        # The moved copy beside the six first events, and its other copy from the other date.
        assert (own.count(), rows_.count()) == (6 + later, 7 + later)
    mine = keyindex.keys_of_load(spark, target.bronze, "two")
    bucket = mine.first()["bucket"]
    looked_up = keyindex.keys_in(spark, target.bronze, [bucket])
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert looked_up.select("bucket").distinct().count() == 1
    refresh_silver(spark, target)
    held = tables.read_table(spark, target.silver, SILVER_DDL)
    assert held.count() == 60


def test_index_of_a_table_written_elsewhere(spark, tmp_path, folder):
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    target = Tables(f"{folder}/tables")
    odd = raw_row("odd", timestamp="2024-01-05 10:00:00")
    twice = [dict(e, timestamp=(BASE + 9 * DAY).isoformat() + ".000Z") for e in events(2)]
    for i, batch in enumerate(([*events(20), odd], twice)):
        write_lines(tmp_path / str(i), [json.dumps(e) for e in batch])
        medallion.load_bronze(spark, str(tmp_path / str(i)), target, at, str(i))
    found = keyindex.strays(spark, target.bronze)
    want = multiset(found)
    assert found.count() == 5
    keyindex.index_bronze(spark, target.bronze)
    assert multiset(keyindex.strays(spark, target.bronze)) == want


def test_session_refresh_reads_adjoining_dates_only(spark, folder, monkeypatch):
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    path, out = f"{folder}/silver", f"{folder}/sessions"
    rows_ = [(f"e{i}", f"u{i % 3}", BASE + i * DAY / 4) for i in range(40)]
    tables.write_table(silver_rows(spark, *rows_), path)
    refresh_sessions(spark, path, out, {r[2].date() for r in rows_}, at)
    seen = []

    def watched(spark, path, dates, schema):
        seen.extend(dates)
        return tables.read_dates(spark, path, dates, schema)

    monkeypatch.setattr(medallion, "read_dates", watched)
    refresh_sessions(spark, path, out, [BASE.date() + 2 * DAY], at)
    assert {(d - BASE.date()).days for d in seen} == {1, 2, 3}
    assert not tables.table_exists(spark, f"{out}/_pending")


def test_catalog_follows_the_dates_of_a_run(spark, tmp_path, folder, monkeypatch):
    """After the first run no partition list is read as a whole; an emptied date goes."""
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    databases = ["f_bronze", "f_silver", "f_gold"]
    first = events(12, days=3)
    lone = raw_row("lone", timestamp=(BASE + 8 * DAY).isoformat() + ".000Z")
    moved = dict(lone, timestamp=(BASE + 9 * DAY).isoformat() + ".000Z")
    write_lines(tmp_path / "one", [json.dumps(e) for e in [*first, lone]])
    write_lines(tmp_path / "two", [json.dumps(moved)])
    later = F.lit(dt.datetime(2024, 2, 2)).cast("timestamp_ntz")
    run_tables(spark, str(tmp_path / "one"), folder, at=at, databases=databases)
    monkeypatch.setattr(medallion, "publish_tables", None)
    last = BASE.date() + 9 * DAY
    target = run_tables(spark, str(tmp_path / "two"), folder, last, at=later, databases=databases)
    want = [BASE.date() + i * DAY for i in (0, 1, 2, 9)]
    for name, path, ddl in [
        ("f_silver.logs_cleaned", target.silver, SILVER_DDL),
        ("f_gold.daily_kpis", target.daily_kpis, DAILY_KPIS_DDL),
        ("f_gold.session_summary", target.sessions, SESSIONS_DDL),
    ]:
        named = spark.table(name)
        assert rows(named.select("event_date").distinct()) == [(d,) for d in want], name
        assert multiset(named) == multiset(tables.read_table(spark, path, ddl)), name
    assert spark.table("f_bronze.raw_logs").count() == 14
    for name in databases:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_upsert_reads_columns_from_their_note(spark, folder, monkeypatch):
    path = f"{folder}/t"
    day = "CAST('2024-01-01' AS DATE) AS event_date"
    tables.upsert_table(spark, path, spark.range(2).selectExpr(day, "id", "'x' AS a"), ["event_date", "id"])
    monkeypatch.setattr(tables, "read_table", None)
    for column in ("b", "c", "b"):
        new = spark.range(1, 3).selectExpr(day, "id", f"'y' AS {column}")
        tables.upsert_table(spark, path, new, ["event_date", "id"])
    monkeypatch.undo()
    assert tables.stored_schema(spark, path).fieldNames() == ["event_date", "id", "a", "b", "c"]
    found = spark.read.schema(tables.stored_schema(spark, path)).parquet(path)
    assert rows(found, "id", "a", "b", "c") == [
        (0, "x", None, None), (1, None, "y", None), (2, None, "y", None)
    ]


def test_lines_with_known_names_are_parsed_once(spark):
    """Only other lines are read as an object of any fields; what is kept stays the same."""
    lines = [
        '{"event_id": "a", "status_code": 200}', '{"event_id": "b", "x": 1, "y": {"k": [1, null]}}',
        '{"event_id": "c", "region"', '[{"event_id": "d", "x": 1}]', '{}', '"text"', '{"event_id": 5} x',
        "{'event_id': 'e', 'z': 'q'}", '{"event_id": "f", "o": {"k": 1, "k": 2}}', '{"x": 2} {"y": 3}',
    ]
    out = parsed(spark, *lines)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "jsonobjectkeys" in plan.lower().replace("_", "")
    fields = [
        F.to_json(F.map_filter(F.from_json("value", kind), lambda n, _: ~n.isin(column_names(raw.READ_DDL))))
        for kind in (raw.TYPED, raw.TEXTS)
    ]
    plain = spark.createDataFrame([(v,) for v in lines], "value string").select(
        F.nullif(F.coalesce(*fields), F.lit("{}"))
    )
    assert [r[0] for r in out.select("_unknown_fields").collect()] == [r[0] for r in plain.collect()]


def test_scattered_ids_need_no_sets(spark, folder):
    """Five numbers for each id tell whether its copies lie on several dates, null included."""
    a, b = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    places = {"one": [(a, a), (a, a)], "odd": [(a, b)], "two": [(a, a), (b, b)], "none": [(None, None)],
              "half": [(a, None)], "lost": [(a, a), (None, None)], "three": [(a, a), (b, b), (b, a)]}
    data = [(k, *p, k != "two") for k, ps in places.items() for p in ps]
    keys = spark.createDataFrame(data, f"{keyindex.KEY_DDL}, _mine BOOLEAN")
    ids = keyindex._scattered_ids(keys)
    assert {r[0] for r in ids.collect()} == {"odd", "half", "lost", "three"}
    assert "collect_set" not in ids._jdf.queryExecution().toString()
    keyindex._write_strays(keys, folder, "x")
    held = keyindex.strays(spark, folder)
    assert multiset(held) == multiset(
        spark.createDataFrame([(k, *p) for k in ("odd", "half", "lost", "three") for p in places[k]], keyindex.KEY_DDL)
    )


def test_undated_copy_counts_when_another_date_is_recomputed(spark, tmp_path, folder):
    """The latest copy has no time; recomputing the date of the earlier one does not revive it."""
    target = Tables(f"{folder}/tables")
    first = events(4, days=2)
    lost = dict(first[0], timestamp="unknown")
    for name, lines, day in (("one", first, 1), ("two", [lost], 2)):
        write_lines(tmp_path / name, [json.dumps(e) for e in lines])
        at = F.lit(dt.datetime(2024, 2, day)).cast("timestamp_ntz")
        medallion.load_bronze(spark, str(tmp_path / name), target, at, name)
    refresh_silver(spark, target)
    before = multiset(tables.read_table(spark, target.silver, SILVER_DDL))
    refresh_silver(spark, target, [BASE.date()])
    assert multiset(tables.read_table(spark, target.silver, SILVER_DDL)) == before


def test_without_copies_elsewhere_bronze_is_read_once(spark, tmp_path, folder):
    target = Tables(f"{folder}/tables")
    at = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")
    write_lines(tmp_path / "one", [json.dumps(e) for e in events(20, days=4)])
    medallion.load_bronze(spark, str(tmp_path / "one"), target, at, "one")
    needed, own = medallion.bronze_for(spark, target.bronze, [BASE.date(), BASE.date() + DAY])
    assert needed.count() == own.count() == 10
    assert needed._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
