"""Column expressions shared by the operators; all are built-in Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of the raw time text, e.g. 2024-01-31T08:15:30.125Z.
RAW_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(x: Column, places: int) -> Column:
    """Decimal half-up rounding, which does not depend on the last bit of a float sum.

    NaN, infinities and numbers beyond the decimal range keep the double rounding.
    """
    exact = F.round(x.try_cast("decimal(38,6)"), places).cast("double")
    return F.coalesce(exact, F.round(x.cast("double"), places))


def event_time(raw: Column | str) -> Column:
    """Raw time text to UTC wall time; null for any other text."""
    c = col(raw)
    return F.when(c.rlike(RAW_TIME_SHAPE), c.try_cast("timestamp_ntz"))


def zoned_time(raw: Column | str) -> Column:
    """Time text to UTC wall time: an offset counts, text without one is UTC already."""
    c = col(raw)
    instant = F.to_utc_timestamp(c.try_cast("timestamp"), F.current_timezone())
    zoned = c.rlike(r"\d:\d{2}.*(?:Z|[+-]\d{2}(?::?\d{2})?)$")
    return F.when(zoned, instant.cast("timestamp_ntz")).otherwise(c.try_cast("timestamp_ntz"))


def whole_seconds(ts: Column | str) -> Column:
    return F.unix_timestamp(col(ts))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes between two times, each cut to whole seconds."""
    return (whole_seconds(end) - whole_seconds(start)) / 60


def status_category(code: Column | str) -> Column:
    c = col(code)
    return (
        F.when(c.between(200, 299), "2xx")
        .when(c.between(300, 399), "3xx")
        .when(c.between(400, 499), "4xx")
        .when(c.between(500, 599), "5xx")
        .otherwise("unknown")
    )


def error_sum(flag: Column | str = "is_error") -> Column:
    """Number of true flags; null when every flag of the group is null."""
    return F.sum(col(flag).cast("int"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def day_name(date: Column | str) -> Column:
    """English name of the weekday."""
    return F.date_format(col(date).cast("timestamp_ntz"), "EEEE")


def row_checksum(cols: Sequence[Column | str]) -> Column:
    """MD5 over the values in order; null differs from an absent value and from ''."""
    return F.md5(F.to_json(F.array(*[col(c).cast("string") for c in cols])))


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def same_row(cols: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def now_or(at: Column | None) -> Column:
    """The given time, or the clock as UTC wall time."""
    if at is not None:
        return at
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
