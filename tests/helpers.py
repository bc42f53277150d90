"""Small hand-written frames."""

import datetime as dt

from runnel.schemas import RAW_DDL, SILVER_DDL, column_names

BASE = dt.datetime(2024, 1, 10, 9, 0, 0)


def raw_row(event_id="e1", **over):
    row = {
        "event_id": event_id,
        "session_id": "s1",
        "user_id": "u1",
        "timestamp": "2024-01-10T09:00:00.000Z",
        "service": "gateway",
        "endpoint": "/a",
        "method": "GET",
        "status_code": 200,
        "latency_ms": 10.0,
        "region": "r1",
        "user_agent": "agent",
        "request_size_bytes": 100,
        "response_size_bytes": 200,
        "is_error": False,
        "error_message": None,
        "trace_id": f"t-{event_id}",
    }
    return {**row, **over}


def raw(spark, *rows):
    names = column_names(RAW_DDL)
    ddl = RAW_DDL.replace(" NOT NULL", "")
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)


def silver(spark, *events):
    """Silver rows from (event_id, user_id, time) and optional further columns."""
    names = column_names(SILVER_DDL)
    rows = []
    for event_id, user, at, *more in events:
        row = dict.fromkeys(names)
        row.update(
            event_id=event_id,
            user_id=user,
            session_id=f"s-{user}",
            event_timestamp=at,
            event_date=at.date() if at else None,
            event_hour=at.hour if at else None,
            service="gateway",
            endpoint="/a",
            region=f"r-{event_id}",
            status_code=200,
            status_category="2xx",
            latency_ms=1.0,
            request_size_bytes=1,
            response_size_bytes=2,
            is_error=False,
        )
        row.update(more[0] if more else {})
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, SILVER_DDL)


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def multiset(df):
    return rows(df.select(*sorted(df.columns)))
