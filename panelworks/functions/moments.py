"""Time expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds per unit for plain interval texts such as "30 seconds".
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(interval: str) -> int:
    """Whole seconds of a one-unit interval text."""
    amount, unit = interval.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def common_pane(window: str, slide: str) -> str:
    """Longest pane that tiles both the window and the slide."""
    return f"{math.gcd(seconds_of(window), seconds_of(slide))} seconds"


def rfc3339(x: Column) -> Column:
    """UTC text with microseconds, e.g. 2024-01-01T00:00:00.000000Z, in any session time zone.

    Time stamps without zone are read as UTC.
    """
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    shifted = F.date_format(F.to_utc_timestamp(x, F.current_timezone()), pattern)
    return F.when(F.typeof(x) == "timestamp_ntz", F.date_format(x, pattern)).otherwise(shifted)


def _micros_of_second(x: Column) -> Column:
    return (F.extract(F.lit("SECOND"), x) * 1_000_000).cast("bigint")


def micros_of(x: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970; a time stamp without zone is read as UTC, and the session's time
    zone plays no part."""
    if not isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(x)
    days = F.datediff(x.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(x)) * 60 + F.minute(x)
    return minutes * 60_000_000 + _micros_of_second(x)


def interval_micros(interval: str) -> int:
    return seconds_of(interval) * 1_000_000


def truncated_to_millis(x: Column) -> Column:
    """Without the microseconds below a millisecond; the type stays, and no zone plays a part."""
    rest = (_micros_of_second(x) % 1000).cast("decimal(18,6)") / 1_000_000
    return x - F.make_dt_interval(secs=rest.cast("decimal(18,6)"))


def name_stamp(x: Column) -> Column:
    """Time stamp for file and folder names, e.g. 20240101_000000_000000."""
    return F.date_format(x, "yyyyMMdd_HHmmss_SSSSSS")


def utc_instant(x: Column) -> Column:
    """Zoned time of a time stamp without zone, read as UTC in any session time zone."""
    return F.from_utc_timestamp(x.cast("timestamp"), F.current_timezone())


def utc_naive(x: Column) -> Column:
    """The UTC wall time of a zoned time stamp; inverse of :func:`utc_instant`."""
    return F.to_utc_timestamp(x, F.current_timezone()).cast("timestamp_ntz")
