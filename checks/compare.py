"""Runs registered queries next to their SQL in DuckDB and reports differences.

Usage: python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("runnel")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", f"file:{tempfile.mkdtemp(prefix='runnel-')}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, name: str) -> str:
    """Empty if the results agree, else the first difference."""
    df = QUERIES[name](spark, sf)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a}\n      != {b}"
    return ""


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = session(), connect(sf), 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, con, sf, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        took = f"{time.time() - start:.1f}s"
        print("DIFF" if found else "ok  ", name, took, found, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
