"""Declared source schemas; the readers raise when a declared column is missing."""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)

# Flight KPI records, one row per arrival (hive-partitioned by ingestion_date).
FLIGHT_RECORDS = StructType([
    StructField("fltid", StringType()),          # callsign
    StructField("adep", StringType()),           # departure airport (ICAO)
    StructField("ades", StringType()),           # destination airport (ICAO)
    StructField("type", StringType()),           # aircraft type
    StructField("reg", StringType()),            # tail registration
    StructField("drwy_validado", StringType()),  # runway
    StructField("bear", DoubleType()),           # bearing, degrees
    StructField("setor", DoubleType()),          # sector, may be NULL
    StructField("c_time", TimestampNTZType()),   # terminal-area entry
    StructField("c", IntegerType()),             # cylinder radius, NM
    StructField("aldt", TimestampNTZType()),     # landing
    StructField("transito", DoubleType()),       # transit, seconds
    StructField("desimp", StringType()),         # unimpeded transit, [-]HH:MM:SS
    StructField("kpi08", StringType()),          # additional transit, [-]HH:MM:SS
])

# Radar points; ds_registration actually holds the callsign (may be 'NULL' text).
RADAR_POINTS = StructType([
    StructField("ds_registration", StringType()),
    StructField("nr_flightlevel", DoubleType()),
    StructField("nr_speed", LongType()),
    StructField("dt_radar", TimestampNTZType()),
])

# Aircraft performance chart: one row per (aircraft, flight level multiple of 10).
FUEL_CHART = StructType([
    StructField("aircraft", StringType()),
    StructField("tas_ms", DoubleType()),
    StructField("fl", IntegerType()),
    StructField("fuel_flow_kg_s", DoubleType()),
])

PARTITION_COLUMN = StructField("ingestion_date", DateType())
