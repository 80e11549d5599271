"""Column-level helpers: every function returns a built-in Spark expression."""

from skylane.functions.numeric import round_half_away, to_decimal, to_int_nearest
from skylane.functions.intervals import parse_interval, interval_seconds
from skylane.functions.timefns import (
    seconds_between, time_bin, bin_seconds, weekday_name, epoch_ntz,
)

__all__ = [
    "round_half_away", "to_decimal", "to_int_nearest", "parse_interval", "interval_seconds",
    "seconds_between", "time_bin", "bin_seconds", "weekday_name", "epoch_ntz",
]
