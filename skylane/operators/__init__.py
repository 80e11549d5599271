"""Analytical operators: DataFrame(s) + ArrivalRules -> DataFrame."""

from skylane.operators.staging import stage_flights, stage_radar, stage_chart
from skylane.operators.flights import enrich_flights, filter_arrivals, latest_flight_per_key
from skylane.operators.radar import radar_in_terminal_area
from skylane.operators.fuel import interpolate_fuel_chart, fuel_flow_at_points
from skylane.operators.profile import vertical_profile
from skylane.operators.occupancy import occupancy_intervals, occupancy_at
from skylane.operators.consumption import flight_fuel, flight_consumption
from skylane.operators.features import fuel_percentile, transit_moving_average, ml_features
from skylane.operators.marts import flight_identifiers, operational_attributes, transit_metrics
from skylane.operators.sequence import lag_in_sequence, sweep
from skylane.operators.percentile import exact_percentile
from skylane.operators.quality import (
    REFERENCE_CHECKS, ColumnCheck, custom_report, non_empty, orphan_keys, run_checks,
)

__all__ = [
    "stage_flights", "stage_radar", "stage_chart",
    "enrich_flights", "filter_arrivals", "latest_flight_per_key",
    "radar_in_terminal_area", "interpolate_fuel_chart", "fuel_flow_at_points",
    "vertical_profile", "occupancy_intervals", "occupancy_at",
    "flight_fuel", "flight_consumption", "fuel_percentile",
    "transit_moving_average", "ml_features",
    "flight_identifiers", "operational_attributes", "transit_metrics",
    "lag_in_sequence", "sweep", "exact_percentile",
    "REFERENCE_CHECKS", "ColumnCheck", "custom_report", "non_empty", "orphan_keys", "run_checks",
]
