"""Terminal-area occupancy as validity intervals, and lookups into them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from skylane.config import ArrivalRules
from skylane.functions.timefns import time_bin
from skylane.operators.sequence import sweep
from skylane.plans.strategy import FlightBounds, broadcast_within, materialize


def occupancy_intervals(radar_tma: DataFrame, rules: ArrivalRules,
                        keys: Sequence[str] = (),
                        bounds: FlightBounds | None = None) -> DataFrame:
    """Number of aircraft in the terminal area between consecutive events.

    Each flight with at least one terminal-area point adds +1 at entry and
    -1 at landing (distinct per flight key and instant).  Per instant:

    * ``tie_rule="first"``: count before the instant, then -1 if any landing
      happens at that instant, else +1 (the reference's first running row,
      landings ordered before entries);
    * ``tie_rule="settled"``: count after all events of the instant.

    Intervals run from an instant to the next (``dt_valid_to`` NULL and
    ``is_current`` on the last); ``id`` numbers them in time order.  The
    running count is a two-level prefix sum over ``rules.sweep_unit``
    segments, so no step sees all instants at once.  ``keys`` (e.g. an
    airport column) give independent sweeps.
    """
    keys = list(keys)
    # one row per flight first, then entry (+1) and landing (-1), distinct per
    # (flight key, instant, kind); the few instants are written once, since the
    # sweep reads them twice
    flights = radar_tma.select(*keys, "id", "c_time", "aldt").distinct()
    both = F.array(F.struct(F.col("c_time").alias("t"), F.lit(1).alias("delta")),
                   F.struct(F.col("aldt").alias("t"), F.lit(-1).alias("delta")))
    events = (flights.select(*keys, "id", F.explode(both).alias("e"))
              .select(*keys, "id", "e.t", "e.delta")
              .where(F.col("t").isNotNull())
              .distinct())
    instants = materialize(events.groupBy(*keys, "t").agg(
        F.sum("delta").cast("bigint").alias("delta"),
        F.max(F.when(F.col("delta") < 0, 1).otherwise(0)).alias("any_exit")), name="instants")
    # segments with an instant: at most 2 per flight and at most the bins in the span
    seg_bound = (None if bounds is None or keys
                 else min(2 * bounds.flights, bounds.bins(rules.sweep_unit)))
    s = sweep(instants, keys, "t", time_bin(F.col("t"), rules.sweep_unit), "delta",
              rules.broadcast_max_rows, seg_bound)
    if rules.tie_rule == "settled":
        n = F.col("running")
    elif rules.tie_rule == "first":
        n = (F.col("running") - F.col("delta")
             + F.when(F.col("any_exit") == 1, F.lit(-1)).otherwise(F.lit(1)))
    else:
        raise ValueError(f"tie_rule must be 'first' or 'settled', not {rules.tie_rule!r}")
    return s.select(
        *keys,
        F.col("row_num").cast("bigint").alias("id"),
        n.cast("bigint").alias("nr_aircraft_in_tma"),
        F.col("t").alias("dt_valid_from"),
        F.col("next_value").alias("dt_valid_to"),
        F.col("next_value").isNull().alias("is_current"),
    )


def occupancy_at(rows: DataFrame, occupancy: DataFrame, time_col: str,
                 rules: ArrivalRules, keys: Sequence[str] = (),
                 bounds: FlightBounds | None = None) -> DataFrame:
    """Add ``nr_aircraft_in_tma`` of the interval with from <= t < to.

    Intervals do not overlap, so at most one matches; the open last interval
    never matches.  An interval is listed under the time bin in which it
    starts; a summary with one row per bin carries the last interval that
    started in an earlier bin.  A row is matched with the intervals of its own
    bin (equi-join, range as a residual) and with its bin's carried one, so an
    interval of any length takes one row.
    """
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    t0, t1 = F.col("dt_valid_from"), F.col("dt_valid_to")
    starts = occupancy.where(t1.isNotNull() & t0.isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], time_bin(t0, rules.interval_unit).alias("_ibin"),
        F.struct(t0.alias("from"), t1.alias("to"), F.col("nr_aircraft_in_tma").alias("n")).alias("_iv"))
    bin_of = time_bin(F.col(time_col), rules.interval_unit)
    bins = rows.where(F.col(time_col).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], bin_of.alias("_ibin")).distinct()
    bins = starts.unionByName(bins.withColumn("_iv", F.lit(None).cast(starts.schema["_iv"].dataType)))
    before = Window.partitionBy(*names).orderBy("_ibin").rowsBetween(Window.unboundedPreceding, -1)
    carried = (bins.groupBy(*names, "_ibin").agg(F.max("_iv").alias("_last"))
               .select(*names, "_ibin", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
               .where(F.col("_carry").isNotNull()))
    flights = None if bounds is None or keys else bounds.flights
    starts = broadcast_within(starts, None if flights is None else 2 * flights, rules.broadcast_max_rows)
    carried = broadcast_within(carried, None if flights is None else 3 * flights, rules.broadcast_max_rows)
    r = rows.withColumn("_bin", bin_of)

    def matched(left: DataFrame, right: DataFrame, interval: str) -> DataFrame:
        t = left[time_col]
        cond = (left["_bin"] == right["_ibin"]) & (t >= right[interval]["from"]) & (t < right[interval]["to"])
        for k, n in zip(keys, names):
            cond = cond & (left[k] == right[n])
        return left.join(right, cond, "left").drop("_ibin", *names)
    j = matched(matched(r, starts, "_iv"), carried, "_carry")
    return j.withColumn("nr_aircraft_in_tma", F.coalesce(F.col("_iv.n"), F.col("_carry.n"))) \
        .drop("_bin", "_iv", "_carry")
