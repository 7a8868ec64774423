"""Scalar time functions on naive (``timestamp_ntz``) columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value) -> Column:
    """A ``timestamp_ntz`` literal from a string, date or datetime."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def to_naive(c) -> Column:
    """Cast to ``timestamp_ntz`` (F12); strings parse as wall-clock time."""
    return col_(c).cast("timestamp_ntz")


def floor_to(c, unit: str = "hour") -> Column:
    """Floor a naive timestamp to a unit, keeping it naive (X1, trap T5).

    ``date_trunc`` answers with a session-zone ``timestamp``; the cast back to
    ``timestamp_ntz`` under a UTC session returns the same wall-clock value.
    """
    return F.date_trunc(unit, col_(c)).cast("timestamp_ntz")


def floor_minutes(c, minutes: int) -> Column:
    """Floor to buckets of ``minutes`` (30-minute buckets etc.)."""
    if minutes == 60:
        return floor_to(c, "hour")
    # Naive arithmetic from a naive epoch: independent of the session zone.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    secs = F.timestamp_diff("SECOND", epoch, col_(c))
    return F.timestamp_add("SECOND", secs - F.pmod(secs, F.lit(60 * minutes)), epoch)


def weekday0(c) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6 (X3; not ``dayofweek``)."""
    return F.weekday(col_(c))


def is_weekend(c) -> Column:
    """1 for Saturday/Sunday, else 0."""
    return (weekday0(c) >= 5).cast("int")


def hour_of_week(c) -> Column:
    """24 * weekday + hour."""
    return weekday0(c) * 24 + F.hour(col_(c))


def minutes_between(start, end) -> Column:
    """Duration in minutes, microsecond exact."""
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end)) / 60_000_000.0


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", col_(start), col_(end)) / 1_000_000.0


def hour_number(c) -> Column:
    """Whole hours since 1970-01-01 00:00 of a naive timestamp."""
    return F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col_(c))


def add_hours(c, hours) -> Column:
    """``t + hours`` on a naive timestamp; ``hours`` may be a column."""
    h = hours if isinstance(hours, Column) else F.lit(int(hours))
    return F.timestamp_add("HOUR", h, col_(c))


def add_days(c, days) -> Column:
    d = days if isinstance(days, Column) else F.lit(int(days))
    return F.timestamp_add("DAY", d, col_(c))


def day_name(c) -> Column:
    """English day name, Monday..Sunday."""
    return F.date_format(col_(c), "EEEE")


def iso_week(c) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(col_(c))


def iso_year(c) -> Column:
    """ISO-8601 week-based year: the year of the Thursday of that week."""
    return F.year(F.date_add(F.to_date(col_(c)), 3 - F.weekday(col_(c))))


def year_month(c) -> Column:
    """``yyyy-MM`` of a timestamp."""
    return F.date_format(col_(c), "yyyy-MM")


def month_from_path(c) -> Column:
    """``yyyy-MM`` taken from a file name like ``yellow_tripdata_2024-01.parquet``."""
    return F.regexp_extract(col_(c), r"(\d{4}-\d{2})\.parquet$", 1)


def dataset_from_path(c) -> Column:
    """Dataset tag taken from ``{dataset}_tripdata_{yyyy-MM}.parquet``."""
    return F.regexp_extract(col_(c), r"([a-z]+)_tripdata_\d{4}-\d{2}\.parquet$", 1)


def hour_range(start, end, step_hours: int = 1) -> Column:
    """Array of naive hourly timestamps from ``start`` to ``end`` inclusive."""
    return F.sequence(ntz(start), ntz(end), F.expr(f"INTERVAL {int(step_hours)} HOUR"))
