"""Fuel burned per flight and the per-flight consumption table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylane.config import ArrivalRules
from skylane.functions.intervals import interval_seconds
from skylane.operators.occupancy import occupancy_at
from skylane.plans.skew import bounded_join
from skylane.plans.strategy import FlightBounds


def flight_fuel(profile: DataFrame) -> DataFrame:
    """``consumption_kg`` = sum of elapsed seconds x fuel flow per flight key
    (rows without fuel flow are skipped; NULL if none has one)."""
    return profile.groupBy("id").agg(
        F.sum(F.col("elapsed") * F.col("fuel_flow")).alias("consumption_kg"))


def flight_fuel_of_steps(steps: DataFrame) -> DataFrame:
    """The same totals from the factorised profile (``steps_of_flights``): an
    instant's elapsed seconds times the sum of its flows, so its k flows are
    summed in their row and never become k rows."""
    flow = F.aggregate("flows", F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)))
    known = F.exists("flows", lambda x: x.isNotNull())
    return steps.groupBy("id").agg(F.sum(F.when(known, F.col("elapsed") * flow)).alias("consumption_kg"))


def flight_consumption(filtered: DataFrame, profile: DataFrame, occupancy: DataFrame,
                       rules: ArrivalRules, bounds: FlightBounds | None = None) -> DataFrame:
    """One row per arrival: fuel burned, occupancy at entry, hour of entry,
    kpi08 and transit in seconds.

    The fuel total is matched by flight key; the output ``id`` is the fuel
    side's key, so arrivals without fuel get a NULL id unless
    ``rules.keep_flight_id``.  The occupancy is the interval in force at entry.
    """
    fuel = flight_fuel(profile).withColumn("_fuel_id", F.col("id"))
    k = filtered.select(
        "id", F.col("landing_time").alias("aldt"), F.col("entry_time").alias("c_time"),
        F.col("flight_date").alias("date"), F.hour("entry_time").cast("int").alias("hour"),
        F.col("departure_airport").alias("adep"), F.col("aircraft_type").alias("aircraft"),
        F.col("runway_validated").alias("drwy_validado"), F.col("bearing").alias("bear"),
        "setor",
        interval_seconds(F.col("kpi08")).alias("kpi08"),
        interval_seconds(F.col("transit_tma")).alias("transit_tma"),
    )
    flights = None if bounds is None else bounds.flights
    j = bounded_join(k, fuel, ["id"], "left", flights, rules.broadcast_max_rows)
    j = occupancy_at(j, occupancy, "c_time", rules, bounds=bounds)
    out_id = F.col("id") if rules.keep_flight_id else F.col("_fuel_id")
    return j.select(
        out_id.alias("id"), "aldt", "c_time", "date", "hour", "adep", "aircraft",
        "drwy_validado", "bear", "setor", "kpi08", "transit_tma",
        F.lit(None).cast("int").alias("visibility"),
        F.lit(None).cast("int").alias("ceiling"),
        "nr_aircraft_in_tma", "consumption_kg",
    )
