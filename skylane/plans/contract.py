"""Contract queries: each runs the library on the stand-in sources built from
a driver test-data folder and returns a DataFrame with stable output types
(integers as bigint, levels and durations as double, rounded doubles where
summation order could differ between engines).  ``oracle.py`` holds the
matching SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylane.config import ArrivalRules
from skylane.functions.intervals import interval_seconds
from skylane.functions.numeric import round_half_away
from skylane.operators import (
    flight_fuel, fuel_percentile, latest_flight_per_key,
    ml_features, occupancy_at, occupancy_intervals, transit_moving_average,
)
from skylane.operators.quality import ENTRY_BEFORE_LANDING, run_checks
from skylane.plans.pipeline import build_layers, quality_report
from skylane.sources.fixture import fixture_sources

# Parameters of the contract queries (the driver tables are small: a flight
# has tens of points at sf0.01, so the point threshold is 15, not 100).
CONTRACT_RULES = ArrivalRules(min_points=15)

QueryFn = Callable[[SparkSession, str], DataFrame]


def _layers(spark: SparkSession, sf_dir: str, rules: ArrivalRules | None = None):
    # shared layers (filtered flights, chart, terminal-area radar, profile,
    # occupancy, consumption) are materialised once and read by every consumer;
    # a query whose result is such a layer takes its plan (``.plan(name)``)
    # over materialised inputs, so the result is not written twice
    return build_layers(fixture_sources(spark, sf_dir), rules or CONTRACT_RULES)


def _secs(name: str, alias: str | None = None):
    return interval_seconds(F.col(name)).alias(alias or name)


def _r(name: str, digits: int):
    return round_half_away(F.col(name), digits).alias(name)


def _big(name: str):
    return F.col(name).cast("bigint").alias(name)


def _dbl(name: str):
    return F.col(name).cast("double").alias(name)


_FLIGHT_COLS = ["id", "flight_date", "flight_id", "departure_airport", "arrival_airport",
                "aircraft_type", "aircraft_registration", "runway_validated", "bearing",
                "setor", "entry_time"]


def _flights_out(df: DataFrame) -> DataFrame:
    return df.select(*_FLIGHT_COLS, _big("cylinder_radius"), "landing_time", "transito",
                     _secs("desimp"), _secs("kpi08"), _secs("transit_tma"))


def q_stg_flights(spark, sf_dir):
    s = _layers(spark, sf_dir)["stg_flights"]
    return s.select("flight_date", "flight_id", "departure_airport", "arrival_airport",
                    "aircraft_type", "aircraft_registration", "runway_validated", "bearing",
                    "setor_raw", "entry_time", _big("cylinder_radius"), "landing_time",
                    "transito_raw", _secs("desimp_raw", "desimp_s"),
                    _secs("kpi08_interval", "kpi08_s"))


def q_stg_radar(spark, sf_dir):
    s = _layers(spark, sf_dir)["stg_radar"]
    return s.select("radar_date", _big("aircraft_speed"), _dbl("flight_level"), "flight_id",
                    "radar_timestamp")


def q_stg_chart(spark, sf_dir):
    s = _layers(spark, sf_dir)["stg_chart"]
    return s.select("aircraft", "tas_ms", _big("fl"), "fuel_flow_kg_s")


def q_flights_enriched(spark, sf_dir):
    return _flights_out(_layers(spark, sf_dir)["flights_enriched"])


def q_flights_filtered(spark, sf_dir):
    return _flights_out(_layers(spark, sf_dir).plan("flights_filtered"))


def q_dim_flight_identifiers(spark, sf_dir):
    return _layers(spark, sf_dir)["dim_flight_identifiers"]


def q_dim_flight_operational_attributes(spark, sf_dir):
    return _layers(spark, sf_dir)["dim_flight_operational_attributes"]


def q_fct_flight_transit_metrics(spark, sf_dir):
    t = _layers(spark, sf_dir)["fct_flight_transit_metrics"]
    return t.select("id", "transito", _secs("desimp"), _secs("kpi08"), _secs("transit_tma"))


def q_flights_latest(spark, sf_dir):
    return latest_flight_per_key(_layers(spark, sf_dir)["flights_filtered"])


def _radar_out(df: DataFrame) -> DataFrame:
    return df.select("id", "dt_radar", _big("nr_speed"), _dbl("fl"), "aircraft_type",
                     "c_time", "aldt")


def q_radar_in_terminal_area(spark, sf_dir):
    return _radar_out(_layers(spark, sf_dir).plan("radar_in_terminal_area"))


def q_radar_cross_midnight(spark, sf_dir):
    rules = CONTRACT_RULES.with_(cross_midnight=True)
    return _radar_out(_layers(spark, sf_dir, rules).plan("radar_in_terminal_area"))


def q_fuel_chart_interpolated(spark, sf_dir):
    c = _layers(spark, sf_dir).plan("fuel_chart_interpolated")
    return c.select("aircraft", _big("fl"), _r("tas_ms", 6), _r("fuel_flow_kg_s", 6))


def q_fuel_at_points(spark, sf_dir):
    f = _layers(spark, sf_dir)["fuel_at_points"]
    return f.select("id", "dt_radar", _dbl("fl"), "aircraft_type", _r("fuel_flow", 6))


def _profile_out(df: DataFrame) -> DataFrame:
    return df.select("id", "aircraft_type", "c_time", "dt_radar", _big("nr_speed"), _dbl("fl"),
                     "avg_rocd", "elapsed", _r("fuel_flow", 6))


def q_vertical_profile(spark, sf_dir):
    return _profile_out(_layers(spark, sf_dir).plan("vertical_profile"))


def q_vertical_profile_own_level(spark, sf_dir):
    rules = CONTRACT_RULES.with_(match_level=True)
    return _profile_out(_layers(spark, sf_dir, rules).plan("vertical_profile"))


def q_occupancy_first(spark, sf_dir):
    return _layers(spark, sf_dir).plan("occupancy")


def q_occupancy_settled(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    return occupancy_intervals(layers["radar_in_terminal_area"],
                               CONTRACT_RULES.with_(tie_rule="settled"), bounds=layers.bounds)


def q_flight_fuel(spark, sf_dir):
    return flight_fuel(_layers(spark, sf_dir)["vertical_profile"]).select(
        "id", _r("consumption_kg", 4))


def q_occupancy_at_entry(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    rows = layers["flights_filtered"].select("id", F.col("entry_time").alias("c_time"))
    return occupancy_at(rows, layers["occupancy"], "c_time", CONTRACT_RULES, bounds=layers.bounds)


def _consumption_out(df: DataFrame) -> DataFrame:
    return df.select("id", "aldt", "c_time", "date", _big("hour"), "adep", "aircraft",
                     "drwy_validado", "bear", "setor", "kpi08", "transit_tma",
                     _big("visibility"), _big("ceiling"), "nr_aircraft_in_tma",
                     _r("consumption_kg", 4))


def q_flight_consumption(spark, sf_dir):
    return _consumption_out(_layers(spark, sf_dir).plan("flight_consumption"))


def q_flight_consumption_keep_id(spark, sf_dir):
    rules = CONTRACT_RULES.with_(keep_flight_id=True)
    return _consumption_out(_layers(spark, sf_dir, rules).plan("flight_consumption"))


def q_fuel_p20(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    base = layers["flight_consumption"]
    return fuel_percentile(base, CONTRACT_RULES, layers.bounds).select(
        "adep", "aircraft", "drwy_validado", _r("consumption_20p", 4))


def q_fuel_p20_ranked(spark, sf_dir):
    """The percentile by range-partitioned ranks (the plan for unbounded groups)."""
    base = _layers(spark, sf_dir)["flight_consumption"]
    return fuel_percentile(base, CONTRACT_RULES, method="range").select(
        "adep", "aircraft", "drwy_validado", _r("consumption_20p", 4))


def q_transit_moving_avg(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    base = layers["flight_consumption"]
    m = transit_moving_average(base, CONTRACT_RULES, bounds=layers.bounds)
    return m.select("id", "aldt", "drwy_validado", "setor", "transit_tma",
                    _r("transit_tma_predicted", 4))


def _features_out(df: DataFrame) -> DataFrame:
    return df.select("id", "date", "adep", "aircraft", "drwy_validado", _big("day"),
                     _big("month"), _big("hour"), "dow", "setor", "kpi08", "transit_tma",
                     _r("transit_tma_predicted", 4), _big("visibility"), _big("ceiling"),
                     _r("consumption_kg", 4), _r("consumption_20p", 4),
                     "nr_aircraft_in_tma", _r("kpi16", 4))


def q_ml_features(spark, sf_dir):
    return _features_out(_layers(spark, sf_dir)["ml_features"])


def q_ml_features_key_join(spark, sf_dir):
    """The reference's form: moving average joined back by the non-unique key."""
    rules = CONTRACT_RULES.with_(row_preserving=False)
    layers = _layers(spark, sf_dir, rules)
    return _features_out(ml_features(layers["flight_consumption"], rules, bounds=layers.bounds))


def q_dq_report(spark, sf_dir):
    return quality_report(_layers(spark, sf_dir))[0]


def q_dq_entry_before_landing(spark, sf_dir):
    """The documented (not declared) rule: entry is not after landing."""
    return run_checks(_layers(spark, sf_dir), [ENTRY_BEFORE_LANDING])


def q_dq_custom(spark, sf_dir):
    return quality_report(_layers(spark, sf_dir))[1]


QUERIES: dict[str, QueryFn] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
