"""Fuel chart interpolation and fuel flow per radar point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skylane.config import ArrivalRules
from skylane.functions.numeric import to_int_nearest
from skylane.plans.strategy import broadcast_within


def interpolate_fuel_chart(chart: DataFrame, rules: ArrivalRules = ArrivalRules(),
                           chart_rows: int | None = None) -> DataFrame:
    """Linear interpolation of the chart to every level 0..max_level.

    A level ``fl`` takes the chart rows at ``lower = fl - fl % step`` and
    ``lower + step``; it exists only when both rows exist with speed and fuel
    (so the top multiple needs the next one).  Duplicate chart rows multiply,
    as a join does.  ``chart_rows`` (rows of ``chart``, counted if None) bounds
    the broadcast side.  Output: aircraft, fl int, tas_ms, fuel_flow_kg_s.
    """
    step = rules.level_step
    points = chart.where(
        F.col("tas_ms").isNotNull() & F.col("fuel_flow_kg_s").isNotNull()
    ).select("aircraft", "fl", "tas_ms", "fuel_flow_kg_s")
    points = broadcast_within(points, chart_rows, rules.broadcast_max_rows)
    lower = points.select("aircraft", F.col("fl").alias("fl_lower"),
                          F.col("tas_ms").alias("tas_lower"),
                          F.col("fuel_flow_kg_s").alias("fuel_lower"))
    upper = points.select("aircraft", F.col("fl").alias("fl_upper"),
                          F.col("tas_ms").alias("tas_upper"),
                          F.col("fuel_flow_kg_s").alias("fuel_upper"))
    levels = (
        chart.select("aircraft").distinct()
        .select("aircraft", F.explode(F.sequence(F.lit(0), F.lit(rules.max_level))).alias("fl"))
        .withColumn("fl_lower", F.col("fl") - F.col("fl") % step)
        .withColumn("fl_upper", F.col("fl_lower") + step)
    )
    j = levels.join(lower, ["aircraft", "fl_lower"]).join(upper, ["aircraft", "fl_upper"])
    # multiply before dividing: the same operation order gives the same doubles
    span = F.col("fl_upper") - F.col("fl_lower")
    offset = F.col("fl") - F.col("fl_lower")
    return j.select(
        "aircraft", "fl",
        (F.col("tas_lower")
         + (F.col("tas_upper") - F.col("tas_lower")).cast("double") * offset / span).alias("tas_ms"),
        (F.col("fuel_lower")
         + (F.col("fuel_upper") - F.col("fuel_lower")).cast("double") * offset / span
         ).alias("fuel_flow_kg_s"),
    )


def level_key(radar: DataFrame) -> Column:
    """Chart level of a radar point: its level rounded to the nearest integer."""
    return to_int_nearest(F.col("fl"), radar.schema["fl"].dataType)


def fuel_lookup(chart_levels: DataFrame, rules: ArrivalRules,
                chart_rows: int | None = None) -> DataFrame:
    """(aircraft_type, _level) -> ``_own_fuels`` array of fuel flows, broadcast.

    One row per distinct (aircraft, level) of the interpolated chart, so at
    most ``chart_rows x (max_level + 1)`` rows; duplicates stay in the array.
    """
    lookup = (chart_levels
              .groupBy(F.col("aircraft").alias("aircraft_type"), F.col("fl").alias("_level"))
              .agg(F.collect_list("fuel_flow_kg_s").alias("_own_fuels")))
    bound = None if chart_rows is None else chart_rows * (rules.max_level + 1)
    return broadcast_within(lookup, bound, rules.broadcast_max_rows)


def fuel_flow_at_points(radar_tma: DataFrame, chart_levels: DataFrame,
                        rules: ArrivalRules = ArrivalRules(),
                        chart_rows: int | None = None) -> DataFrame:
    """Fuel flow per terminal-area point from the interpolated chart at the
    point's rounded level (one row per matching chart row); points without a
    chart row are dropped.  Output: id, dt_radar, fl, aircraft_type, fuel_flow."""
    pts = radar_tma.select("id", "dt_radar", "fl", "aircraft_type",
                           level_key(radar_tma).alias("_level"))
    return pts.join(fuel_lookup(chart_levels, rules, chart_rows), ["aircraft_type", "_level"]).select(
        "id", "dt_radar", "fl", "aircraft_type", F.explode("_own_fuels").alias("fuel_flow"))
