import datetime as dt
import random

from pyspark.sql import Window, functions as F

from skylane.config import ArrivalRules
from skylane.functions.timefns import time_bin
from skylane.operators import interpolate_fuel_chart, stage_chart, vertical_profile
from skylane.operators.fuel import fuel_flow_at_points
from skylane.operators.sequence import lag_in_sequence
from tests.helpers import T, chart_df

TMA = ("id string, dt_radar timestamp_ntz, nr_speed bigint, fl decimal(18,3), "
       "aircraft_type string, c_time timestamp_ntz, aldt timestamp_ntz")


def _tma(spark, rows):
    base = (T(2024, 1, 1, 10), T(2024, 1, 1, 12))
    full = [(i, t, s, fl, ac, *base) for (i, t, s, fl, ac) in rows]
    df = spark.createDataFrame(full, "id string, dt_radar timestamp_ntz, nr_speed bigint, "
                                     "fl double, aircraft_type string, c_time timestamp_ntz, "
                                     "aldt timestamp_ntz")
    return df.withColumn("fl", F.col("fl").cast("decimal(18,3)"))


def _levels(spark, rows, rules=ArrivalRules()):
    return interpolate_fuel_chart(stage_chart(chart_df(spark, rows)), rules)


def test_interpolation_needs_both_neighbours(spark):  # N4
    lv = _levels(spark, [("X", 1.0, 0, 0.1), ("X", 2.0, 10, 0.2), ("X", 4.0, 30, 0.4)])
    assert sorted(r.fl for r in lv.collect()) == list(range(0, 10))


def test_interpolation_values(spark):  # N4
    lv = _levels(spark, [("X", 10.0, 100, 1.0), ("X", 20.0, 110, 2.0)])
    got = {r.fl: (r.tas_ms, r.fuel_flow_kg_s) for r in lv.collect()}
    assert 110 not in got and sorted(got) == list(range(100, 110))
    assert got[105] == (15.0, 1.5) and got[100] == (10.0, 1.0)


def test_fuel_at_points_rounds_half_levels_away_from_zero(spark):  # N5, T1
    lv = _levels(spark, [("X", 10.0, 0, 1.0), ("X", 20.0, 10, 2.0)])
    tma = _tma(spark, [("f", T(2024, 1, 1, 10, 1), 200, 2.5, "X"),
                       ("f", T(2024, 1, 1, 10, 2), 200, 3.5, "X"),
                       ("f", T(2024, 1, 1, 10, 3), 200, 50.0, "X")])
    got = sorted((float(r.fl), round(r.fuel_flow, 6)) for r in fuel_flow_at_points(tma, lv).collect())
    assert got == [(2.5, 1.3), (3.5, 1.4)]


CHART = [("X", 10.0, 80, 0.8), ("X", 10.0, 90, 0.9), ("X", 10.0, 100, 1.0),
         ("X", 10.0, 110, 2.0), ("X", 10.0, 120, 3.0)]


def test_fan_out_across_levels_at_one_instant(spark):  # T4
    lv = _levels(spark, CHART)
    t0, t1 = T(2024, 1, 1, 10, 0), T(2024, 1, 1, 10, 1)
    tma = _tma(spark, [("f", t0, 200, 90.0, "X"), ("f", t1, 200, 100.0, "X"),
                       ("f", t1, 200, 110.0, "X")])
    rules = ArrivalRules(min_points=1)
    rows = vertical_profile(tma, lv, rules).collect()
    assert sorted((float(r.fl), r.elapsed, r.fuel_flow) for r in rows) == [
        (100.0, 60.0, 1.0), (100.0, 60.0, 2.0)]
    assert rows[0].avg_rocd == round(100 * 10 / 60, 2)
    own = vertical_profile(tma, lv, rules.with_(match_level=True)).collect()
    assert [(float(r.fl), r.fuel_flow) for r in own] == [(100.0, 1.0)]


def test_sub_millisecond_step_gives_null_rate(spark):  # T12
    lv = _levels(spark, CHART)
    t0 = T(2024, 1, 1, 10, 0)
    tma = _tma(spark, [("f", t0, 200, 90.0, "X"),
                       ("f", t0 + dt.timedelta(microseconds=200), 200, 100.0, "X")])
    r = vertical_profile(tma, lv, ArrivalRules(min_points=1)).collect()
    assert len(r) == 1 and abs(r[0].elapsed - 0.0002) < 1e-12 and r[0].avg_rocd is None


def test_min_points_counted_before_dropping_zero_steps(spark):  # D5
    lv = _levels(spark, CHART)
    t0 = T(2024, 1, 1, 10, 0)
    tma = _tma(spark, [("f", t0, 200, 90.0, "X"), ("f", t0, 200, 100.0, "X"),
                       ("f", t0 + dt.timedelta(minutes=1), 200, 80.0, "X"),
                       ("g", t0, 200, 90.0, "X"), ("g", t0 + dt.timedelta(minutes=1), 200, 80.0, "X")])
    got = {r.id for r in vertical_profile(tma, lv, ArrivalRules(min_points=3)).collect()}
    assert got == {"f"}


def test_segmented_lag_equals_plain_lag(spark):  # W3 design
    rnd = random.Random(7)
    rows = []
    for f in range(6):
        t = T(2024, 1, 1, rnd.randrange(24), rnd.randrange(60))
        for _ in range(rnd.randrange(1, 60)):
            t += dt.timedelta(seconds=rnd.choice([0, 4, 30, 600, 3700]))
            rows.append((f"f{f}", t, float(rnd.randrange(400))))
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, v double").dropDuplicates(["id", "t", "v"])
    plain = (df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("id").orderBy("t", "v")))
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("id"))))
    for unit in ("minute", "hour", "day"):
        seg = lag_in_sequence(df, ["id"], ["t", "v"], time_bin(F.col("t"), unit), ["v"],
                              count_col="n").select("id", "t", "v", "prev_v", "n")
        plain = plain.select("id", "t", "v", "prev_v", "n")
        assert sorted(seg.collect()) == sorted(plain.collect()), unit


def test_sequence_step_spreads_the_largest_flight(spark):
    """The previous-point step runs per (flight, hour), so the flight with the
    most points is processed by several tasks, not one."""
    from skylane.plans.pipeline import build_layers
    from skylane.sources.fixture import fixture_sources
    layers = build_layers(fixture_sources(spark, "/root/testdata/sf0.01"), ArrivalRules(min_points=15))
    tma = layers["radar_in_terminal_area"]
    top = tma.groupBy("id").count().orderBy(F.desc("count"), "id").first().id
    seq = lag_in_sequence(tma, ["id"], ["dt_radar", "fl"], time_bin(F.col("dt_radar"), "hour"),
                          ["dt_radar", "fl"], mode="none")  # one plan: the step's own placement
    # the planned hash placement; adaptive execution would merge or locally
    # re-read these tiny partitions
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # use the step's output, or the optimizer drops the window and the join
        rows = (seq.where(F.col("id") == top)
                .select(F.spark_partition_id().alias("p"), "prev_dt_radar").collect())
        parts = len({r.p for r in rows})
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert parts > 1


def test_duplicate_chart_rows_multiply_like_joins(spark):  # D2, D3, D4 join semantics
    lv = _levels(spark, [("X", 10.0, 0, 1.0), ("X", 12.0, 0, 1.2), ("X", 20.0, 10, 2.0)])
    at5 = sorted(round(r.fuel_flow_kg_s, 6) for r in lv.where("fl = 5").collect())
    assert at5 == [1.5, 1.6]  # two lower rows x one upper row
    t0 = T(2024, 1, 1, 10, 0)
    tma = _tma(spark, [("f", t0, 200, 4.0, "X"), ("f", t0 + dt.timedelta(minutes=1), 200, 5.0, "X")])
    pts = sorted(round(r.fuel_flow, 6) for r in fuel_flow_at_points(tma, lv).collect()
                 if float(r.fl) == 5.0)
    assert pts == [1.5, 1.6]
    prof = vertical_profile(tma, lv, ArrivalRules(min_points=1)).collect()
    assert sorted(round(r.fuel_flow, 6) for r in prof) == [1.5, 1.6]


def test_many_rows_at_one_instant(spark):  # D4
    """10,000 points of one instant: one row of flows there, 10,000 output rows
    only in the profile, and the fuel total without them."""
    from skylane.operators.consumption import flight_fuel, flight_fuel_of_steps
    from skylane.operators.profile import instants_of_flights, steps_of_flights
    lv = _levels(spark, CHART)
    t0, t1, t2 = (T(2024, 1, 1, 10, m) for m in (0, 1, 2))
    rows = [("f", t0, 200, 90.0, "X"), ("f", t2, 200, 80.0, "X")]
    rows += [("f", t1, 200, 80 + k / 1000 * 3, "X") for k in range(10_000)]
    tma = _tma(spark, rows).cache()
    rules = ArrivalRules(min_points=10_002)
    instants = {r.dt_radar: (r.points, len(r.flows)) for r in instants_of_flights(tma, lv, rules).collect()}
    assert instants[t0] == (1, 1) and instants[t1][0] == 10_000 and 10_000 <= instants[t1][1] < 20_000
    profile = vertical_profile(tma, lv, rules)
    assert profile.count() == instants[t1][1] + instants[t2][1]
    steps = steps_of_flights(tma, lv, rules)
    assert steps.count() == 2
    one, other = (f(x).collect()[0].consumption_kg for f, x in ((flight_fuel, profile), (flight_fuel_of_steps, steps)))
    assert abs(one - other) < 1e-6 * one
    assert vertical_profile(tma, lv, rules.with_(min_points=10_003)).count() == 0


def test_points_are_exchanged_once(spark):  # W3
    """The profile's plans: no window gathers flows, one exchange moves the rows
    of points, and the boundary rows are read from the written instants."""
    from skylane.operators.profile import instants_of_flights, steps_of_flights
    lv = _levels(spark, CHART)
    t0 = T(2024, 1, 1, 10, 0)
    tma = _tma(spark, [("f", t0 + dt.timedelta(minutes=7 * k), 200, 80.0 + k, "X") for k in range(30)])
    rules = ArrivalRules(min_points=1)
    points = instants_of_flights(tma, lv, rules, chart_rows=len(CHART))._jdf.queryExecution().executedPlan().toString()
    assert points.count("Exchange hashpartitioning(id") == 1 and "Window" not in points
    steps = steps_of_flights(tma, lv, rules, chart_rows=len(CHART))
    plan = steps._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "LocalTableScan" not in plan and "ExistingRDD" not in plan  # written rows only
    assert steps.count() == 29
