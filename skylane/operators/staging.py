"""Staging: rename and cast the raw inputs; no filters, joins or calculations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skylane.functions.intervals import parse_interval
from skylane.functions.numeric import to_decimal


def stage_flights(raw: DataFrame) -> DataFrame:
    """Flight KPI records -> typed flight rows (durations become intervals)."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(
        F.col("aldt").cast("date").alias("flight_date"),
        F.col("fltid").alias("flight_id"),
        F.col("adep").cast("string").alias("departure_airport"),
        F.col("ades").cast("string").alias("arrival_airport"),
        F.col("type").alias("aircraft_type"),
        F.col("reg").alias("aircraft_registration"),
        F.col("drwy_validado").alias("runway_validated"),
        F.col("bear").alias("bearing"),
        F.col("setor").alias("setor_raw"),
        F.col("c_time").cast("timestamp_ntz").alias("entry_time"),
        F.col("c").alias("cylinder_radius"),
        F.col("aldt").cast("timestamp_ntz").alias("landing_time"),
        F.col("transito").alias("transito_raw"),
        parse_interval(F.col("desimp"), types["desimp"]).alias("desimp_raw"),
        parse_interval(F.col("kpi08"), types["kpi08"]).alias("kpi08_interval"),
    )


def stage_radar(raw: DataFrame) -> DataFrame:
    """Radar points -> typed points; the callsign column is renamed flight_id."""
    level_type = raw.schema["nr_flightlevel"].dataType
    return raw.select(
        F.col("dt_radar").cast("date").alias("radar_date"),
        F.col("nr_speed").alias("aircraft_speed"),
        to_decimal(F.col("nr_flightlevel"), level_type).alias("flight_level"),
        F.col("ds_registration").alias("flight_id"),
        F.col("dt_radar").cast("timestamp_ntz").alias("radar_timestamp"),
    )


def stage_chart(raw: DataFrame) -> DataFrame:
    """Fuel chart -> (aircraft, tas_ms, fl int, fuel_flow_kg_s double)."""
    return raw.select(
        F.col("aircraft"),
        F.col("tas_ms"),
        F.col("fl").cast("int").alias("fl"),
        F.col("fuel_flow_kg_s").cast("double").alias("fuel_flow_kg_s"),
    )
