"""Radar points confined to each flight's terminal-area window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from skylane.config import ArrivalRules
from skylane.functions.timefns import epoch_micros, epoch_ntz
from skylane.operators.flights import latest_flight_per_key
from skylane.plans.skew import bounded_join
from skylane.plans.strategy import FlightBounds


POINT = ("flight_key", "flight_level", "aircraft_type", "c_time", "aldt", "radar_timestamp", "aircraft_speed")

# A speed takes 64 bits of a packed order, moved above zero.
_SPEEDS, _LOWEST = "18446744073709551616", "9223372036854775808"  # 2**64, 2**63


def packed_order(time: Column, speed: Column) -> Column:
    """(time, speed) as one whole number of the same order: microseconds times
    2**64 plus the speed.  Any pair of 64-bit values up to the year 9999 fits
    decimal(38, 0), whose minimum an aggregate updates in place."""
    micros = epoch_micros(time).cast("decimal(18,0)")
    return (micros * F.lit(_SPEEDS).cast("decimal(20,0)") + (speed.cast("decimal(20,0)") + F.lit(_LOWEST).cast("decimal(19,0)"))) \
        .cast("decimal(38,0)")


def unpacked_order(packed: Column, speed_type: DataType) -> tuple[Column, Column]:
    """The time and speed of ``packed_order``."""
    below = F.pmod(packed, F.lit(_SPEEDS).cast("decimal(38,0)"))
    micros = ((packed - below) / F.lit(_SPEEDS).cast("decimal(38,0)")).cast("bigint")
    time = F.timestamp_add("MICROSECOND", micros, epoch_ntz())
    return time, (below.cast("decimal(20,0)") - F.lit(_LOWEST).cast("decimal(19,0)")).cast(speed_type)


def radar_in_terminal_area(filtered: DataFrame, stg_radar: DataFrame,
                           rules: ArrivalRules, bounds: FlightBounds | None = None) -> DataFrame:
    """Radar points of each flight between entry and landing (inclusive).

    1. one flight per key (latest landing);
    2. points with a real callsign, level and speed, equi-joined to the flight
       on (callsign, date) with the time window as a residual — the flights
       side (one row per flight, bounded by ``bounds.flights``; counted when no
       bound is given or flights span midnight) is broadcast when within
       ``broadcast_max_rows``, so radar is not shuffled for the join; beyond
       it, callsigns with very many points are dealt into parts (``split_join``);
    3. first point per (flight, level): earliest time, ties by lower speed.
       This is a partial-then-final hash aggregate over a packed (time, speed),
       so a flight with very many points never lands whole in one task.

    With ``bounds``, radar is first limited to the flights' overall time span.
    ``rules.cross_midnight`` also matches points dated before the day of landing:
    windows of up to ``rules.window_days`` days by (callsign, day), longer ones
    by callsign, so a window takes a bounded number of rows whatever its length.
    Output: id, dt_radar, nr_speed, fl (decimal), aircraft_type, c_time, aldt.
    """
    flights = latest_flight_per_key(filtered)
    radar = stg_radar.where(
        F.col("flight_id").isNotNull()
        & (F.col("flight_id") != F.lit("NULL"))
        & F.col("flight_level").isNotNull()
        & F.col("aircraft_speed").isNotNull()
    )
    if bounds is not None and bounds.first_time is not None:
        # implied by every flight's window; reaches the Parquet scan as a data
        # filter, so row groups outside the flights' time span are skipped
        # literals from ISO text: no session time zone is involved
        radar = radar.where(F.col("radar_timestamp").between(
            F.lit(bounds.first_time.isoformat(sep=" ")).cast("timestamp_ntz"),
            F.lit(bounds.last_time.isoformat(sep=" ")).cast("timestamp_ntz")))
    flights = flights.select(
        "flight_id", "flight_date", F.col("id").alias("flight_key"), "aircraft_type",
        F.col("entry_time").alias("c_time"), F.col("landing_time").alias("aldt"))
    # one row per flight (short windows across midnight: one per day)
    flight_bound = None if bounds is None else bounds.flights
    inside = (F.col("radar_timestamp") >= F.col("c_time")) & (F.col("radar_timestamp") <= F.col("aldt"))
    if rules.cross_midnight:
        days = F.datediff(F.col("aldt").cast("date"), F.col("c_time").cast("date")) + 1
        short = days <= rules.window_days
        side = flights.where(short).withColumn("radar_date", F.explode(F.sequence(
            F.col("c_time").cast("date"), F.col("aldt").cast("date"))))
        joined = bounded_join(radar, side, ["flight_id", "radar_date"], "inner",
                              flight_bound and flight_bound * rules.window_days, rules.broadcast_max_rows).where(inside)
        # a window of many days (a wrong entry date, say) is one row, met by callsign
        long = bounded_join(radar, flights.where(~short), ["flight_id"], "inner", flight_bound, rules.broadcast_max_rows)
        joined = joined.select(*POINT).unionByName(long.where(inside).select(*POINT))
    else:
        side = flights.withColumnRenamed("flight_date", "radar_date")
        joined = bounded_join(radar, side, ["flight_id", "radar_date"], "inner", flight_bound,
                              rules.broadcast_max_rows).where(inside).select(*POINT)
    # the flight's columns depend on its key; grouping by them keeps them fixed,
    # and time and speed are one whole number, so the minimum has a fixed width
    # and the hash aggregate can hold it
    first = joined.groupBy("flight_key", F.col("flight_level").alias("fl"), "aircraft_type", "c_time", "aldt") \
        .agg(F.min(packed_order(F.col("radar_timestamp"), F.col("aircraft_speed"))).alias("_first"))
    dt_radar, speed = unpacked_order(F.col("_first"), joined.schema["aircraft_speed"].dataType)
    return first.select(F.col("flight_key").alias("id"), dt_radar.alias("dt_radar"), speed.alias("nr_speed"), "fl",
                        "aircraft_type", "c_time", "aldt")
