"""Business rules and execution knobs.

The defaults reproduce the reference pipeline; every hard-coded value of the
reference is a parameter here, so the same code serves other airports.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- Fixed values taken from the reference (arrival rules for one airport) ---
DESTINATION = "SBGR"
CYLINDER_RADIUS_NM = 100
ORIGIN_PREFIX = "SB"
AIRCRAFT_TYPES = (
    "A320", "A321", "B738", "B38M",
    "A20N", "A319", "A21N", "E195", "B737", "B734",
)
SECTORS = ("0", "60", "120", "180", "240", "300")
WEEKDAY_NAMES = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
# --- end of fixed values ---


@dataclass(frozen=True)
class ArrivalRules:
    """Parameters of the arrival analytics.

    Business rules (reference defaults):
      destination, cylinder_radius, origin_prefix, aircraft_types: flight filter.
      min_points: a flight enters the vertical profile only with at least this
        many terminal-area radar points.
      percentile: fraction for the fuel reference percentile (linear interpolation).
      horizon_seconds: look-back of the moving transit-time average.
      max_level, level_step: fuel chart interpolation grid.
      tie_rule: ``"first"`` or ``"settled"`` occupancy count at shared instants.

    Fidelity flags:
      match_level (False = reference): attach fuel flow of the point's own
        level only, instead of every level recorded at the same instant.
      keep_flight_id (False = reference): consumption rows keep the flight
        key even without fuel.
      row_preserving (True; False = reference): the moving average is computed
        per row.  The reference joins it back by the non-unique flight key,
        which emits k x k rows for k rows sharing a key — quadratic when one
        key is hot — so the linear form is the default.
      cross_midnight (False = reference): radar points before midnight of a
        flight that lands after midnight are kept.

    Scale knobs:
      broadcast_max_rows: a side is broadcast only when bounded below this.
      group_max_rows: a percentile group is merged in one task only when
        bounded below this (else range-partitioned ranks).
      sweep_unit: segment of the global occupancy sweep ("day" or "hour").
      profile_unit: segment of the per-flight sequence step ("hour"...).
      interval_unit: bin of the point-in-interval join.
      moving_avg_unit: partition bin of the moving average.
      rows_per_file: target size of the files of a day of radar points.
      window_days: terminal-area windows of at most so many days are matched
        to points by day, longer ones by callsign (with ``cross_midnight``).
    """

    destination: str = DESTINATION
    cylinder_radius: int = CYLINDER_RADIUS_NM
    origin_prefix: str = ORIGIN_PREFIX
    aircraft_types: tuple[str, ...] = AIRCRAFT_TYPES
    min_points: int = 100
    percentile: float = 0.2
    horizon_seconds: int = 3600
    max_level: int = 400
    level_step: int = 10
    tie_rule: str = "first"

    match_level: bool = False
    keep_flight_id: bool = False
    row_preserving: bool = True
    cross_midnight: bool = False

    broadcast_max_rows: int = 1_000_000
    group_max_rows: int = 1_000_000
    sweep_unit: str = "day"
    profile_unit: str = "hour"
    interval_unit: str = "hour"
    moving_avg_unit: str = "day"
    rows_per_file: int = 5_000_000
    window_days: int = 3

    def with_(self, **kw) -> "ArrivalRules":
        return replace(self, **kw)
