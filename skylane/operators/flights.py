"""Flight-side operators: key + sector imputation, arrival filter, latest per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skylane.config import ArrivalRules
from skylane.functions.numeric import to_int_nearest


def enrich_flights(stg: DataFrame) -> DataFrame:
    """Add the flight key ``id`` (date || callsign), sector text and transit.

    sector = integer part of the raw sector when present (rounded to nearest),
    else ``floor(bearing / 60) * 60``, else NULL; ``transit_tma = desimp + kpi08``.
    """
    setor_type = stg.schema["setor_raw"].dataType
    setor = (
        F.when(F.col("setor_raw").isNotNull(),
               to_int_nearest(F.col("setor_raw"), setor_type).cast("string"))
         .when(F.col("bearing").isNotNull(),
               (F.floor(F.col("bearing") / 60) * 60).cast("int").cast("string"))
    )
    return stg.select(
        F.concat(F.col("flight_date").cast("string"), F.col("flight_id")).alias("id"),
        "flight_date", "flight_id", "departure_airport", "arrival_airport",
        "aircraft_type", "aircraft_registration", "runway_validated", "bearing",
        setor.alias("setor"),
        "entry_time", "cylinder_radius", "landing_time",
        F.col("transito_raw").alias("transito"),
        F.col("desimp_raw").alias("desimp"),
        F.col("kpi08_interval").alias("kpi08"),
        (F.col("desimp_raw") + F.col("kpi08_interval")).alias("transit_tma"),
    )


def filter_arrivals(enriched: DataFrame, rules: ArrivalRules) -> DataFrame:
    """Arrivals at the destination, inside the cylinder, with KPI and sector,
    from origins with the prefix, of the selected aircraft types."""
    return enriched.where(
        (F.col("arrival_airport") == F.lit(rules.destination))
        & (F.col("cylinder_radius") == F.lit(rules.cylinder_radius))
        & F.col("kpi08").isNotNull()
        & F.col("setor").isNotNull()
        & F.col("departure_airport").startswith(rules.origin_prefix)
        & F.col("aircraft_type").isin(list(rules.aircraft_types))
    )


def latest_flight_per_key(filtered: DataFrame) -> DataFrame:
    """One flight per key: latest landing; ties -> earlier entry, then type.

    Planned as a top-1 window; Spark evaluates a partial top-1 before the
    shuffle, so each key sends at most one row per map task.
    """
    w = Window.partitionBy("id").orderBy(
        F.col("landing_time").desc_nulls_last(),
        F.col("entry_time").asc_nulls_last(),
        F.col("aircraft_type").asc_nulls_last(),
    )
    return (
        filtered
        .select("id", "flight_id", "flight_date", "aircraft_type", "entry_time", "landing_time")
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )
