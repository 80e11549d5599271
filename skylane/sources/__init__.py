"""Sources (flight records, radar points, fuel chart), sinks and the test fixture."""

from skylane.sources.schemas import FLIGHT_RECORDS, RADAR_POINTS, FUEL_CHART
from skylane.sources.readers import (
    Sources, read_flight_records, read_radar_points, read_fuel_chart,
)
from skylane.sources.published import Versions, read_published

__all__ = [
    "FLIGHT_RECORDS", "RADAR_POINTS", "FUEL_CHART",
    "Sources", "read_flight_records", "read_radar_points", "read_fuel_chart",
    "Versions", "read_published",
]
