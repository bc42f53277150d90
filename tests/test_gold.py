import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.operators import gold
from runnel.operators.percentiles import exact_percentiles, ordered_bucket
from runnel.plans import dashboard
from tests.helpers import BASE, rows, silver

PROBS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def value_sets(seed):
    rng = random.Random(seed)
    return {
        "lognormal": [round(rng.lognormvariate(4.5, 0.8), 2) for _ in range(500)],
        "one atom": [100.0] * 300 + [rng.uniform(0, 1000) for _ in range(100)],
        "dense": [100 + i * 1e-7 for i in range(400)],
        "signs": [rng.uniform(-50, 50) for _ in range(101)] + [0.0, -0.0],
        "huge": [10.0 ** rng.randint(-300, 300) for _ in range(50)],
        "single": [7.25],
        "endless": [1.0] + [float("inf")] * 40,
        None: [1.0, 2.0],
    }


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_percentiles_equal_numpy(spark, broadcast_rows):
    sets = value_sets(1)
    data = [(k, v) for k, vs in sets.items() for v in vs] + [("lognormal", None), ("empty", None)]
    random.Random(2).shuffle(data)
    df = spark.createDataFrame(data, "k string, v double")
    out = exact_percentiles(df, ["k"], "v", PROBS, broadcast_rows)
    got = {r["k"]: [r[p] for p in PROBS] for r in out.collect()}
    assert set(got) == set(sets)
    for k, vs in sets.items():
        want = np.percentile(vs, [100 * p for p in PROBS.values()])
        if k == "endless":
            want = [1.0] + [float("inf")] * 4
        assert np.allclose(got[k], want, rtol=1e-12, atol=0), k


def test_buckets_never_fall(spark):
    values = sorted({v for vs in value_sets(3).values() for v in vs})
    values = [float("-inf"), *values, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.orderBy("v").select(ordered_bucket(F.col("v"))).collect()]
    assert got == sorted(got)


def events(n=400):
    rng = random.Random(7)
    return [
        (
            f"e{i}",
            f"u{rng.randrange(9)}",
            BASE + dt.timedelta(hours=rng.randrange(72)),
            {
                "service": rng.choice(["a", "b", None]),
                "latency_ms": None if i % 17 == 0 else rng.uniform(0, 900),
                "is_error": rng.choice([True, False, None]),
            },
        )
        for i in range(n)
    ]


def test_daily_kpis_by_plain_loop(spark):
    data = events()
    out = gold.daily_kpis(silver(spark, *data), exact=True)
    cells = {}
    for e in data:
        cells.setdefault((e[2].date(), e[3]["service"]), []).append(e)
    got = {(r["event_date"], r["service"]): r for r in out.drop("region").collect()}
    assert out.select("region").distinct().count() == len(data)
    one_region = silver(spark, *[(*e[:3], {**e[3], "region": "r"}) for e in data])
    out = gold.daily_kpis(one_region, exact=True)
    got = {(r["event_date"], r["service"]): r for r in out.collect()}
    assert set(got) == set(cells)
    for key, members in cells.items():
        r = got[key]
        lat = [m[3]["latency_ms"] for m in members if m[3]["latency_ms"] is not None]
        flags = [m[3]["is_error"] for m in members if m[3]["is_error"] is not None]
        assert r["total_requests"] == len(members)
        assert r["total_errors"] == (sum(flags) if flags else None)
        assert r["unique_users"] == len({m[1] for m in members})
        assert r["p95_latency_ms"] == pytest.approx(np.percentile(lat, 95), abs=0.00501)
        assert r["avg_latency_ms"] == pytest.approx(np.mean(lat), abs=0.00501)


def test_sketched_percentile_is_an_existing_value_near_the_rank(spark):
    vals = [float(i) for i in range(20_000)]
    df = spark.createDataFrame([(v,) for v in vals], "latency_ms double").select(
        F.lit(1).alias("event_date"), F.lit("s").alias("service"), F.lit("r").alias("region"), "*"
    )
    r = gold.approx_percentiles(df, accuracy=1000).first()
    assert abs(r["p95_latency_ms"] - 19_000) <= 20_000 / 1000


def test_region_share_counts_the_whole(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0, 0.0), ("a", 1, 3.0, 1.0), ("b", 1, 5.0, 2.0)],
        "region string, total_requests bigint, avg_latency_ms double, error_rate_pct double",
    )
    out = dashboard.region_traffic(df)
    assert rows(out) == [("a", 2, 66.67, 2.0, 0.5), ("b", 1, 33.33, 5.0, 2.0)]


def test_session_buckets_limits(spark):
    mins = [0.99, 1.0, 4.99, 5.0, 14.99, 15.0, 29.99, 30.0, None]
    df = spark.createDataFrame(
        [(m, 2, 1) for m in mins],
        "session_duration_mins double, total_events bigint, errors_in_session bigint",
    )
    out = dashboard.session_buckets(df)
    assert rows(out, "duration_bucket", "session_count") == sorted(
        [("< 1 min", 1), ("1-5 mins", 2), ("5-15 mins", 2), ("15-30 mins", 2), ("> 30 mins", 2)]
    )


def test_weekday_names(spark):
    df = silver(spark, *[(f"e{i}", "u", dt.datetime(2024, 1, 7 + i)) for i in range(7)])
    out = dashboard.error_heatmap(df)
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert rows(out, "day_num", "day_name") == list(enumerate(names, 1))


def test_top_endpoints_breaks_ties_by_name(spark):
    df = silver(spark, *[(f"e{i}", "u", BASE, {"endpoint": f"/{i % 12:02d}"}) for i in range(24)])
    assert [r["endpoint"] for r in dashboard.top_endpoints(df).collect()] == [
        f"/{i:02d}" for i in range(10)
    ]
