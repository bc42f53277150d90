"""Times all registered table queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores, BENCH_QUERIES (comma
separated) limits the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = list(QUERIES)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "registered table queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
