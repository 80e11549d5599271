"""Time arithmetic on zone-less timestamps (timestamp_ntz).

Bins are integers counted from 1970-01-01 00:00, computed without any time
zone, so a bin key means the same on every executor and session.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skylane.config import WEEKDAY_NAMES

EPOCH_TEXT = "1970-01-01 00:00:00"


def epoch_ntz() -> Column:
    return F.lit(EPOCH_TEXT).cast("timestamp_ntz")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def bin_seconds(unit: str) -> int:
    try:
        return _UNIT_SECONDS[unit]
    except KeyError:
        raise ValueError(f"unknown time unit {unit!r}; use one of {sorted(_UNIT_SECONDS)}")


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from ``start`` to ``end`` (bigint)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds as double (like epoch of an interval)."""
    return micros_between(start, end).cast("double") / F.lit(1e6)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp_ntz (bigint)."""
    return micros_between(epoch_ntz(), ts)


def time_bin(ts: Column, unit: str) -> Column:
    """Integer bin number of ``ts`` for bins of one ``unit`` (floor division)."""
    width = bin_seconds(unit) * 1_000_000
    return F.floor(epoch_micros(ts) / F.lit(width)).cast("bigint")


def weekday_name(ts: Column) -> Column:
    """Three-letter weekday, Sunday first (``extract(dow)`` 0 = Sunday)."""
    dow = F.dayofweek(ts) - 1
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.when(dow.between(0, 6), F.element_at(names, dow + 1)).otherwise(F.lit("invalid"))
