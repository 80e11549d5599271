"""Vertical profile: rate of climb/descent, elapsed time and fuel flow per point."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from skylane.config import ArrivalRules
from skylane.functions.numeric import round_half_away, to_decimal
from skylane.functions.timefns import seconds_between, time_bin
from skylane.operators.fuel import fuel_lookup, level_key
from skylane.operators.sequence import lag_in_sequence
from skylane.plans.strategy import FlightBounds


def instants_of_flights(radar_tma: DataFrame, chart_levels: DataFrame, rules: ArrivalRules,
                        chart_rows: int | None = None) -> DataFrame:
    """One row per (flight, instant) with a point: the instant's lowest point
    (``first``: fl, nr_speed, aircraft_type, c_time), its highest level
    ``last_fl``, its number of ``points`` and the fuel flows ``flows`` of all its
    points (of the lowest one only with ``rules.match_level``).

    Points of one instant differ in level, so only the lowest has a previous
    point at an earlier time; the others follow it in no time and leave the
    profile.  A row per instant therefore holds all that the profile needs, and
    an instant of k points takes one row of k flows, not k rows of k.
    """
    pts = radar_tma.where(F.col("dt_radar").isNotNull()).select(
        "id", "aircraft_type", "c_time", "dt_radar", "nr_speed", "fl")
    pts = pts.withColumn("_level", level_key(pts)).join(
        fuel_lookup(chart_levels, rules, chart_rows), ["aircraft_type", "_level"], "left")
    own = F.coalesce("_own_fuels", F.array().cast("array<double>"))
    first = F.struct("fl", "nr_speed", "aircraft_type", "c_time", *([own.alias("own")] if rules.match_level else []))
    flows = F.col("first.own") if rules.match_level else F.flatten("_flows")
    return pts.groupBy("id", "dt_radar").agg(
        F.min(first).alias("first"), F.max("fl").alias("last_fl"), F.count(F.lit(1)).alias("points"),
        *([] if rules.match_level else [F.collect_list(own).alias("_flows")])) \
        .select("id", "dt_radar", "first", "last_fl", "points", flows.alias("flows"))


def steps_of_flights(radar_tma: DataFrame, chart_levels: DataFrame, rules: ArrivalRules,
                     chart_rows: int | None = None, mode: str = "table") -> DataFrame:
    """The instants of flights with at least ``min_points`` points that follow
    another instant: id, dt_radar, the lowest point's columns, ``avg_rocd``,
    ``elapsed`` and the multiset ``flows`` of the instant's fuel flows."""
    instants = instants_of_flights(radar_tma, chart_levels, rules, chart_rows)
    seq = lag_in_sequence(instants, keys=["id"], order=["dt_radar"],
                          segment=time_bin(F.col("dt_radar"), rules.profile_unit),
                          cols=["dt_radar", "last_fl"], count_col="_n", weight="points", mode=mode)
    delta = seconds_between(F.col("prev_dt_radar"), F.col("dt_radar"))
    seconds_ms = F.nullif(to_decimal(delta, DoubleType()), F.lit(0)).cast("double")
    climb = (F.lit(100) * (F.col("first.fl") - F.col("prev_last_fl"))).cast("double")
    return seq.where(F.col("prev_dt_radar").isNotNull() & (F.col("_n") >= F.lit(rules.min_points))).select(
        "id", "first.aircraft_type", "first.c_time", "dt_radar", "first.nr_speed", "first.fl",
        round_half_away(climb / seconds_ms, 2).alias("avg_rocd"), delta.alias("elapsed"), "flows")


def vertical_profile(radar_tma: DataFrame, chart_levels: DataFrame,
                     rules: ArrivalRules, bounds: FlightBounds | None = None,
                     chart_rows: int | None = None, mode: str = "table") -> DataFrame:
    """Per terminal-area point of flights with at least ``min_points`` points
    (counted before dropping anything):

    * ``elapsed`` = seconds since the flight's previous point (0 if none),
    * ``avg_rocd`` = round(100 * level change / seconds, 2) with the seconds
      rounded to milliseconds; NULL when that is 0 — the value is in ft/s,
    * points with ``elapsed = 0`` are dropped,
    * ``fuel_flow`` = chart fuel flow of every point of the same flight recorded
      at the same instant (one output row each; one NULL row if none matches).
      ``rules.match_level`` keeps only the point's own level.

    Points are ordered by time, then level.  The work runs on one row per
    instant (``instants_of_flights``), and the previous instant is found per
    (flight, time segment) with a carry across segments, so one long or dense
    flight is spread over several tasks.  Points without a time have no place
    in the order and take no part.  ``bounds`` is accepted for a uniform
    signature (the profile needs no flight-level broadcast).
    Output: id, aircraft_type, c_time, dt_radar, nr_speed, fl, avg_rocd,
    elapsed, fuel_flow.
    """
    steps = steps_of_flights(radar_tma, chart_levels, rules, chart_rows, mode)
    return steps.select("id", "aircraft_type", "c_time", "dt_radar", "nr_speed", "fl",
                        "avg_rocd", "elapsed", F.explode_outer("flows").alias("fuel_flow"))
