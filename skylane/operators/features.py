"""ML-ready features: calendar parts, fuel percentile and moving transit time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from skylane.config import ArrivalRules
from skylane.functions.timefns import bin_seconds, epoch_micros, weekday_name
from skylane.operators.percentile import exact_percentile
from skylane.plans.skew import bounded_join
from skylane.plans.strategy import FlightBounds, broadcast_within

FUEL_GROUP = ("adep", "aircraft", "drwy_validado")


def fuel_percentile(base: DataFrame, rules: ArrivalRules,
                    bounds: FlightBounds | None = None, method: str | None = None) -> DataFrame:
    """Exact percentile (linear interpolation, NULLs ignored) of the fuel burned
    per (origin, aircraft type, runway) — ``consumption_20p``.

    A group has at most one row per flight, so the flight bound decides whether
    a group may be merged in one task (see ``exact_percentile``).
    """
    return exact_percentile(
        base, FUEL_GROUP, "consumption_kg", rules.percentile, "consumption_20p",
        group_bound=None if bounds is None else bounds.flights,
        max_group_rows=rules.group_max_rows, broadcast_max_rows=rules.broadcast_max_rows,
        method=method)


def transit_moving_average(df: DataFrame, rules: ArrivalRules,
                           partition: Sequence[str] = ("drwy_validado", "setor"),
                           time_col: str = "aldt", value: str = "transit_tma",
                           out: str = "transit_tma_predicted",
                           bounds: FlightBounds | None = None) -> DataFrame:
    """Average of ``value`` over rows of the same partition whose time lies in
    [t - horizon, t] (rows at the same instant included; NULL times average
    among themselves).

    The window is partitioned by time bins (``rules.moving_avg_unit``) as well,
    so a busy runway/sector is split across tasks.  Rows are
    copied as context into the later bins within the horizon and dropped after the window.
    Rows without a time are all peers of each other, so their value is the
    plain average of their partition: a map-side-combined aggregate joined
    back (on a NULL-safe struct key), not a one-task window.
    """
    horizon = rules.horizon_seconds * 1_000_000
    width = bin_seconds(rules.moving_avg_unit) * 1_000_000
    partition = list(partition)
    timed = df.where(F.col(time_col).isNotNull())
    t = epoch_micros(F.col(time_col))
    own = F.floor(t / F.lit(width)).cast("bigint")
    # every bin that the row's horizon reaches, however long it is
    bins = F.sequence(own, F.floor((t + F.lit(horizon)) / F.lit(width)).cast("bigint"))
    rows = timed.select("*", t.alias("_t"), own.alias("_own"), F.explode(bins).alias("_bin"))
    w = (Window.partitionBy(*partition, "_bin").orderBy(F.col("_t"))
         .rangeBetween(-horizon, Window.currentRow))
    with_time = (rows.withColumn(out, F.avg(value).over(w))
                 .where(F.col("_bin") == F.col("_own"))
                 .drop("_t", "_own", "_bin"))

    untimed = df.where(F.col(time_col).isNull()).withColumn("_pk", F.struct(*partition))
    peers = untimed.groupBy("_pk").agg(F.avg(value).alias(out))
    without_time = bounded_join(untimed, peers, ["_pk"], "left", _group_bound(bounds, rules),
                                rules.broadcast_max_rows).drop("_pk")
    return with_time.unionByName(without_time)


def _group_bound(bounds: FlightBounds | None, rules: ArrivalRules) -> int | None:
    """Bound of a table with one row per group: the number of flights where
    that is small enough, else unknown, so that the groups are counted."""
    if bounds is None or bounds.flights > rules.broadcast_max_rows:
        return None
    return bounds.flights


def ml_features(consumption: DataFrame, rules: ArrivalRules,
                bounds: FlightBounds | None = None) -> DataFrame:
    """Feature table: calendar parts of the landing, weekday name, fuel
    percentile of the (origin, type, runway) group, moving transit average
    and ``kpi16 = consumption_kg - consumption_20p``.

    By default the moving average is computed on each row (one output row per
    consumption row).  ``rules.row_preserving=False`` matches it back by the
    non-unique flight key like the reference, which emits every pairing of rows
    sharing a key (k x k rows for k such rows).
    """
    base = consumption.select(
        "*",
        F.dayofmonth("aldt").cast("int").alias("day"),
        F.month("aldt").cast("int").alias("month"),
        weekday_name(F.col("aldt")).alias("dow"),
    )
    # the moving average has at most one row per consumption row (= per flight)
    flights = None if bounds is None else bounds.flights
    with_p = bounded_join(base, fuel_percentile(base, rules, bounds), FUEL_GROUP, "left",
                          _group_bound(bounds, rules), rules.broadcast_max_rows)
    if rules.row_preserving:
        full = transit_moving_average(with_p, rules, bounds=bounds)
    else:
        moving = transit_moving_average(base, rules, bounds=bounds).select(
            F.col("id").alias("_mid"), "transit_tma_predicted")
        moving = broadcast_within(moving, flights, rules.broadcast_max_rows)
        full = with_p.join(moving, with_p["id"] == moving["_mid"], "left").drop("_mid")
    return full.select(
        "id", "date", "adep", "aircraft", "drwy_validado", "day", "month", "hour", "dow",
        "setor", "kpi08", "transit_tma", "transit_tma_predicted", "visibility", "ceiling",
        "consumption_kg", "consumption_20p", "nr_aircraft_in_tma",
        (F.col("consumption_kg") - F.col("consumption_20p")).alias("kpi16"),
    )
