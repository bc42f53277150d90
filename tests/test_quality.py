import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from runnel.functions.columns import event_time, rounded, status_category
from runnel.operators import quality, silver
from runnel.schemas import RAW_DDL, SILVER_DDL, column_names, struct
from tests.helpers import multiset, raw, raw_row, rows


def test_split_keeps_every_row_and_names_the_null_columns(spark):
    df = raw(
        spark,
        raw_row("ok"),
        raw_row(None),
        raw_row("no_user", user_id=None),
        raw_row("no_time", timestamp=None),
        raw_row("two", user_id=None, status_code=None),
    )
    valid, bad = quality.split_nulls(df)
    assert rows(valid, "event_id") == [("ok",)]
    assert rows(bad, "event_id", "_dq_null_cols") == sorted(
        [
            (None, "event_id"),
            ("no_user", "user_id"),
            ("no_time", "timestamp"),
            ("two", "user_id,status_code"),
        ],
        key=str,
    )
    reason = "Null in: ['event_id', 'user_id', 'timestamp', 'status_code']"
    assert {r[0] for r in rows(bad, "_dq_reason")} == {reason}
    assert valid.count() + bad.count() == df.count()


def test_dedup_keeps_the_latest_and_is_deterministic_on_ties(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "q"), ("b", 5, "p"), ("c", None, "n")]
    df = spark.createDataFrame(data, "event_id string, seq int, body string")
    out = quality.dedup_latest(df, ["event_id"], "seq", ["body"])
    assert rows(out) == [("a", 2, "y"), ("b", 5, "p"), ("c", None, "n")]
    by_hash = quality.dedup_latest(df, ["event_id"], "seq")
    again = quality.dedup_latest(df.repartition(5), ["event_id"], "seq")
    assert multiset(by_hash) == multiset(again)


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("concat('k', id % 2) AS event_id", "id AS seq")
    plan = quality.dedup_latest(df, ["event_id"], "seq")._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_value_flags_at_the_limits(spark):
    cases = [
        (-0.01, 200, "negative_latency,"),
        (0.0, 100, ""),
        (60000.0, 599, ""),
        (60000.01, 600, "invalid_status,extreme_latency,"),
        (None, 99, "invalid_status,"),
        (None, None, ""),
        (-1.0, 0, "negative_latency,invalid_status,"),
    ]
    df = spark.createDataFrame(cases, "latency_ms double, status_code int, want string")
    out = quality.value_flags(df).where("NOT (want <=> _dq_flags)")
    assert out.count() == 0


def test_status_category_limits(spark):
    cases = [
        (99, "unknown"), (199, "unknown"), (200, "2xx"), (299, "2xx"), (300, "3xx"),
        (399, "3xx"), (400, "4xx"), (499, "4xx"), (500, "5xx"), (599, "5xx"),
        (600, "unknown"), (None, "unknown"),
    ]
    df = spark.createDataFrame(cases, "code int, want string")
    assert df.where(status_category("code") != F.col("want")).count() == 0


def test_event_time_takes_only_the_raw_shape_in_any_zone(spark):
    cases = [
        ("2024-03-10T02:30:00.123Z", dt.datetime(2024, 3, 10, 2, 30, 0, 123000)),
        ("2024-03-10 02:30:00", None),
        ("2024-13-01T00:00:00.000Z", None),
        ("soon", None),
        (None, None),
    ]
    df = spark.createDataFrame(cases, "raw string, want timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert df.where(~event_time("raw").eqNullSafe(F.col("want"))).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rounded_is_half_up_and_survives_odd_numbers(spark):
    df = spark.createDataFrame([(2.005, 2.01), (-2.005, -2.01), (1e30, 1e30), (None, None)],
                               "x double, want double")
    assert df.where(~rounded(F.col("x"), 2).eqNullSafe(F.col("want"))).count() == 0
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e300,)], "x double")
    got = [r[0] for r in odd.select(rounded(F.col("x"), 2)).collect()]
    assert got[0] != got[0] and got[1] == float("inf") and got[2] == 1e300


def test_summary_counts(spark):
    df = raw(spark, raw_row("a"), raw_row("a"), raw_row("b"), raw_row("c", user_id=None))
    assert rows(quality.dq_summary(df)) == [(4, 3, 1, 1)]
    assert rows(quality.dq_summary(df.limit(0))) == [(0, 0, 0, 0)]


def test_observed_counts_come_with_the_write(spark, folder):
    df = raw(spark, raw_row("a"), raw_row("b"), raw_row("c", user_id=None))
    seen = Observation()
    quality.observe_quality(df, seen).write.parquet(f"{folder}/t")
    assert seen.get == {"total_rows": 3, "valid_rows": 2, "quarantined_rows": 1}


def test_schema_drift(spark):
    base = raw(spark, raw_row("a"), raw_row("b"))
    expected = struct(spark, RAW_DDL)
    assert quality.schema_drift(base, expected).count() == 0
    changed = (
        base.drop("method")
        .withColumn("status_code", F.when(F.col("event_id") == "a", "x").otherwise("200"))
        .withColumn("extra", F.lit(1))
    )
    assert rows(quality.schema_drift(changed, expected)) == sorted(
        [
            ("extra", "extra", None, "int", 2, 0),
            ("method", "missing", "string", None, 0, 0),
            ("status_code", "type", "int", "string", 2, 1),
        ],
        key=str,
    )


def test_schema_drift_of_types_without_a_cast(spark):
    df = spark.createDataFrame([(True,), (None,)], "event_date boolean")
    out = quality.schema_drift(df, struct(spark, "event_date DATE"))
    assert rows(out) == [("event_date", "type", "date", "boolean", 1, 1)]


def test_table_stats(spark):
    out = quality.table_stats(spark.range(0, 10, 1, 3).select("id"), "t").collect()[0]
    assert tuple(out) == ("t", 10, 3)
    empty = quality.table_stats(spark.range(0).select("id"), "t").collect()[0]
    assert empty["row_count"] == 0


def test_silver_columns_and_unparsable_time(spark):
    audit = {"_ingested_at": F.lit("2024-02-01").cast("timestamp_ntz"), "_source_file": F.lit("f")}
    df = raw(spark, raw_row("a"), raw_row("b", timestamp="yesterday")).withColumns(audit)
    out = silver.to_silver(df)
    assert out.columns == column_names(SILVER_DDL)
    assert rows(out, "event_id", "event_date", "event_hour") == [
        ("a", dt.date(2024, 1, 10), 9),
        ("b", None, None),
    ]
    flagged = silver.to_silver(df.withColumn("latency_ms", F.lit(-1.0)), keep_flags=True)
    assert {r[0] for r in rows(flagged, "_dq_flags")} == {"negative_latency,"}


def test_sql_silver_casts_text_columns(spark):
    df = raw(spark, raw_row("a"), raw_row("b", timestamp="2024-01-10 23:10:00"))
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    text = text.withColumn("status_code", F.when(F.col("event_id") == "a", "x").otherwise("404"))
    out = silver.to_silver_sql(text)
    assert rows(out, "event_id", "status_code", "status_category", "event_hour", "is_error") == [
        ("a", None, "unknown", 9, False),
        ("b", 404, "4xx", 23, False),
    ]


def test_incremental_takes_today_and_yesterday(spark):
    days = [(dt.date(2024, 1, d),) for d in (27, 28, 29, 30, 31)] + [(None,)]
    df = spark.createDataFrame(days, "event_date date")
    out = silver.incremental(df, dt.date(2024, 1, 30))
    assert [r[0].day for r in rows(out)] == [29, 30, 31]


def test_time_offsets_count(spark):
    from runnel.functions.columns import zoned_time

    texts = ["2024-01-10T00:30:00+02:00", "2024-01-10T00:30:00.000Z", "2024-01-10 00:30:00", "2024-01-10", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(zoned_time("t").cast("string")).collect()]
    assert found == ["2024-01-09 22:30:00", "2024-01-10 00:30:00", "2024-01-10 00:30:00", "2024-01-10 00:00:00", None]
