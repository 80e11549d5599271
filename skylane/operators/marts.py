"""Dimension and fact projections of the filtered arrivals (key is not unique)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def flight_identifiers(filtered: DataFrame) -> DataFrame:
    return filtered.select(
        "id", F.col("departure_airport").alias("adep"), F.col("arrival_airport").alias("ades"),
        F.col("flight_id").alias("fltid"), F.col("aircraft_type").alias("aircraft"),
        F.col("aircraft_registration").alias("reg"), F.col("flight_date").alias("date"))


def operational_attributes(filtered: DataFrame) -> DataFrame:
    return filtered.select(
        "id", F.col("runway_validated").alias("drwy_validado"), F.col("bearing").alias("bear"),
        "setor", F.col("entry_time").alias("c_time"), F.col("landing_time").alias("aldt"))


def transit_metrics(filtered: DataFrame) -> DataFrame:
    """id, transito and the three durations (intervals)."""
    return filtered.select("id", "transito", "desimp", "kpi08", "transit_tma")
