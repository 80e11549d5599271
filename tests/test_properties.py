"""Property tests: the segmented sweep equals the single-window definition."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from skylane.config import ArrivalRules
from skylane.operators import occupancy_intervals

TMA = ("id string, dt_radar timestamp_ntz, nr_speed bigint, fl decimal(18,3), "
       "aircraft_type string, c_time timestamp_ntz, aldt timestamp_ntz")
BASE = dt.datetime(2024, 1, 1)

flights = st.lists(st.tuples(st.integers(0, 6 * 24 * 6), st.integers(0, 200)), min_size=1,
                   max_size=40)


@settings(max_examples=15, deadline=None)
@given(flights, st.sampled_from(["hour", "day"]), st.sampled_from(["first", "settled"]))
def test_sweep_equals_single_window(spark, fl, unit, tie_rule):
    rows = [(f"f{i}", None, 1, None, "X", BASE + dt.timedelta(minutes=10 * a),
             BASE + dt.timedelta(minutes=10 * a + 10 * d)) for i, (a, d) in enumerate(fl)]
    tma = spark.createDataFrame(rows, TMA)
    got = sorted(tuple(r) for r in occupancy_intervals(
        tma, ArrivalRules(sweep_unit=unit, tie_rule=tie_rule)).collect())
    ev = (tma.select("id", F.col("c_time").alias("t"), F.lit(1).alias("d"))
          .unionByName(tma.select("id", F.col("aldt").alias("t"), F.lit(-1).alias("d")))
          .distinct().groupBy("t").agg(F.sum("d").alias("d"), F.min("d").alias("m")))
    w = Window.orderBy("t")
    run = F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    n = run if tie_rule == "settled" else run - F.col("d") + F.when(F.col("m") < 0, -1).otherwise(1)
    ref = ev.select(F.row_number().over(w), n.cast("bigint"), "t", F.lead("t").over(w),
                    F.lead("t").over(w).isNull())
    assert got == sorted(tuple(r) for r in ref.collect())


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 99), st.integers(0, 59),
                          st.integers(0, 59)), min_size=1, max_size=50))
def test_interval_text_parsing(spark, parts):
    from skylane.functions import interval_seconds, parse_interval
    texts = [f"{'-' if neg else ''}{h:02d}:{m:02d}:{s:02d}" for neg, h, m, s in parts]
    want = [(-1 if neg else 1) * (h * 3600 + m * 60 + s) for neg, h, m, s in parts]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(interval_seconds(parse_interval(F.col("s")))).collect()]
    assert got == [float(w) for w in want]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=50))
def test_rounding_matches_the_reference_engine(spark, xs):
    """``round_half_away(x, 2)`` equals DuckDB's ``round(x, 2)`` (trap T8)."""
    import duckdb
    from skylane.functions import round_half_away
    xs = xs + [1.005, 0.285, -0.125, 2.675]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, 2)", [x]).fetchone()[0] for x in xs]
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e6, 1e6, allow_nan=False),
                          st.integers(-10**9, 10**9).map(lambda us: us / 1e6)),
                min_size=1, max_size=50))
def test_decimal_cast_matches_the_reference_engine(spark, xs):
    """``to_decimal`` equals DuckDB's ``CAST(x AS DECIMAL(18,3))`` (levels, ROCD seconds)."""
    import duckdb
    from pyspark.sql.types import DoubleType
    from skylane.functions import to_decimal
    xs = xs + [0.5005, 0.0005, 0.0025, -0.0025, 12.3445]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(to_decimal(F.col("x"), DoubleType())).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT CAST(?::DOUBLE AS DECIMAL(18,3))", [x]).fetchone()[0] for x in xs]
    assert got == want
