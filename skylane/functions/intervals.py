"""Interval text -> day-time interval, and interval -> seconds.

Accepted text: ``[-]HH:MM[:SS[.ffffff]]`` (hours may exceed 24); amounts with
units (``12 minutes``, ``1 hour 5 minutes``, ``2 days``, ``1.5h``), with a clock
part after them (``2 days 03:00:00``); a plain number of seconds; ``ago`` at the
end turns the sign.  Units are weeks to microseconds.  Any other text (months
and years too, which have no fixed length) raises an error at run time: a
duration that became NULL would drop its flight without a trace.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DayTimeIntervalType, StringType

# Unit names and their microseconds.
_UNITS = {
    "microseconds microsecond us usec usecs": 1,
    "milliseconds millisecond ms msec msecs": 1_000,
    "seconds second secs sec s": 1_000_000,
    "minutes minute mins min m": 60_000_000,
    "hours hour hrs hr h": 3_600_000_000,
    "days day d": 86_400_000_000,
    "weeks week w": 604_800_000_000,
}
_AMOUNTS = r"(-?\d+(?:\.\d+)?)\s*([a-z]+)"
_CLOCK = r"(-?)(\d+):([0-5]?\d)(?::([0-5]?\d(?:\.\d+)?)?)?"
_TEXT = rf"^\s*((?:-?\d+(?:\.\d+)?\s*[a-z]+\s*)*)(?:{_CLOCK})?\s*(ago)?\s*$"
_SECONDS = r"^\s*(-?\d+(?:\.\d+)?)\s*$"


def parse_interval(c: Column, source_type: DataType = StringType()) -> Column:
    """Parse a duration column into a day-time interval (NULL stays NULL)."""
    if isinstance(source_type, DayTimeIntervalType):
        return c
    text = F.lower(c.cast("string"))
    part = lambda i: F.regexp_extract(text, _TEXT, i)
    number = lambda x: F.when(x == "", 0).otherwise(x.try_cast("decimal(20,6)"))
    units = F.create_map(*[F.lit(x) for names, us in _UNITS.items() for n in names.split() for x in (n, us)])
    amounts = F.zip_with(F.regexp_extract_all(part(1), F.lit(_AMOUNTS), F.lit(1)),
                         F.regexp_extract_all(part(1), F.lit(_AMOUNTS), F.lit(2)),
                         lambda n, u: n.try_cast("decimal(20,6)") * F.try_element_at(units, u))
    words = F.aggregate(amounts, F.lit(0).cast("decimal(38,6)"), lambda s, x: (s + x).cast("decimal(38,6)"))
    clock = (number(part(3)) * 3600 + number(part(4)) * 60 + number(part(5))) * 1_000_000
    total = (words + F.when(part(2) == "-", -clock).otherwise(clock)) * F.when(part(6) != "", -1).otherwise(1)
    plain = F.regexp_extract(text, _SECONDS, 1).try_cast("decimal(20,6)") * 1_000_000
    micros = F.when(text.rlike(_SECONDS), plain).when(text.rlike(_TEXT) & text.rlike(r"\d"), total)
    bad = F.raise_error(F.concat(F.lit("not a duration: "), c.cast("string"))).cast("decimal(38,6)")
    seconds = F.when(c.isNotNull(), F.coalesce(micros.cast("decimal(38,6)"), bad)) / 1_000_000
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def interval_seconds(c: Column) -> Column:
    """Seconds (double, microsecond precision) of a day-time interval."""
    return c.cast("interval second").cast("decimal(18,6)").cast("double")
