"""Readers for the three inputs.

Parquet datasets are read with a declared schema from a base directory, so
hive-style partition directories (``ingestion_date=...``) become a column and
a date range on that column prunes whole directories before any file is opened.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skylane.sources.schemas import (
    FLIGHT_RECORDS, FUEL_CHART, PARTITION_COLUMN, RADAR_POINTS,
)


@dataclass(frozen=True)
class Sources:
    """The three inputs of the pipeline, in the source schemas."""

    flights: DataFrame
    radar: DataFrame
    chart: DataFrame


def _require(columns: list[str], schema: StructType, path: str) -> None:
    """Raise if a declared column is missing (read as declared, it would be
    NULL in every row)."""
    missing = [f.name for f in schema.fields if f.name.lower() not in {c.lower() for c in columns}]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}; it has {', '.join(columns)}")


def _read_parquet(spark: SparkSession, path: str, schema: StructType,
                  partitioned: bool, start: dt.date | None, end: dt.date | None) -> DataFrame:
    full = StructType(schema.fields + [PARTITION_COLUMN]) if partitioned else schema
    _require(spark.read.parquet(path).columns, full, path)
    df = spark.read.schema(full).parquet(path)
    if partitioned and start is not None:
        df = df.where(F.col(PARTITION_COLUMN.name) >= F.lit(start))
    if partitioned and end is not None:
        df = df.where(F.col(PARTITION_COLUMN.name) <= F.lit(end))
    return df


def read_flight_records(spark: SparkSession, path: str, partitioned: bool = True,
                        start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Flight KPI records; ``start``/``end`` prune ``ingestion_date`` partitions."""
    return _read_parquet(spark, path, FLIGHT_RECORDS, partitioned, start, end)


def read_radar_points(spark: SparkSession, path: str, partitioned: bool = True,
                      start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Radar points (the largest input); same partition pruning as the flights."""
    return _read_parquet(spark, path, RADAR_POINTS, partitioned, start, end)


def read_fuel_chart(spark: SparkSession, path: str) -> DataFrame:
    """Fuel chart seed: CSV whose header names at least the four declared
    columns, in any order; a value that is not of its column's type raises."""
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    _require(raw.columns, FUEL_CHART, path)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in FUEL_CHART.fields])
