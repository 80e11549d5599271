"""Inputs that earlier lost data without an error: duration text, missing
Parquet columns, reordered CSV columns; and plans whose result or cost must not
depend on Spark reusing an exchange."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from skylane.config import ArrivalRules
from skylane.functions.intervals import interval_seconds, parse_interval
from skylane.operators.occupancy import occupancy_at, occupancy_intervals
from skylane.operators.percentile import exact_percentile
from skylane.sources.readers import read_flight_records, read_fuel_chart, read_radar_points

FORMS = ["750", "00:12", "12 minutes", "1 hour 5 minutes", "2 days", "1.5 hours", "1h", "5 min", "3 s", "-1 day 02:00:00",
         "1 day -02:00:00", "-00:01:30", "00:01:30.5", "100:00:00", "1:2:3", "2 weeks", "90 seconds ago", "10 ms", "5 us",
         "  00:10:00  ", "1 Day 2 HOURS", "-5", "1d2h", "00:12:", "1 hour 00:05:00", "0.5 days", "-1.5 seconds"]


def test_interval_forms_equal_duckdb(spark):
    df = spark.createDataFrame([(t,) for t in [*FORMS, None]], "t string")
    got = {r.t: r.s for r in df.select("t", interval_seconds(parse_interval(F.col("t"))).alias("s")).collect()}
    con = duckdb.connect()
    for t in FORMS:
        assert got[t] == pytest.approx(con.execute("SELECT epoch(CAST(? AS INTERVAL))", [t]).fetchall()[0][0], abs=1e-9), t
    assert got[None] is None


@pytest.mark.parametrize("text", ["", "abc", "P1D", "12 minutes 30", "00:61:00", "1 month", "1 day, 2 hours", "ago"])
def test_other_text_raises(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(interval_seconds(parse_interval(F.col("t"))))
    with pytest.raises(Exception, match="not a duration"):
        df.collect()


def test_missing_parquet_column_raises(spark, tmp_path):
    spark.range(1).selectExpr("'X' AS ds_registration", "1D AS nr_flightlevel", "current_date() AS ingestion_date") \
        .write.partitionBy("ingestion_date").parquet(str(tmp_path / "radar"))
    with pytest.raises(ValueError, match="lacks the columns nr_speed, dt_radar"):
        read_radar_points(spark, str(tmp_path / "radar"))
    with pytest.raises(ValueError, match="lacks the columns"):
        read_flight_records(spark, str(tmp_path / "radar"))


def test_chart_columns_bind_by_name(spark, tmp_path):
    path = tmp_path / "chart.csv"
    path.write_text("aircraft,fl,tas_ms,note,fuel_flow_kg_s\nA320,10,100.5,x,0.25\n")
    row = read_fuel_chart(spark, str(path)).collect()[0]
    assert (row.aircraft, row.tas_ms, row.fl, row.fuel_flow_kg_s) == ("A320", 100.5, 10, 0.25)
    path.write_text("aircraft,fl,fuel_flow_kg_s\nA320,10,0.25\n")
    with pytest.raises(ValueError, match="tas_ms"):
        read_fuel_chart(spark, str(path))
    path.write_text("aircraft,fl,tas_ms,fuel_flow_kg_s\nA320,ten,1,1\n")
    with pytest.raises(Exception, match="(?i)cast"):
        read_fuel_chart(spark, str(path)).collect()


@pytest.mark.parametrize("reuse,adaptive", [("true", "true"), ("false", "true"), ("false", "false")])
def test_ranked_percentile_without_exchange_reuse(spark, reuse, adaptive):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
                                     ((F.col("id") * 7919) % 100_003 / 7.0).alias("v"))
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", 0.2).alias("p")).collect()}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = {r.g: r.p for r in exact_percentile(df, ["g"], "v", 0.2, "p", None, 10, 1000, method="range").collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == pytest.approx(want)


def _points(spark, flights):
    rows = [(i, entry, landing) for i, entry, landing in flights for _ in range(5)]
    return spark.createDataFrame(rows, "id string, c_time timestamp_ntz, aldt timestamp_ntz")


def test_occupancy_reads_radar_once(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    _points(spark, [(f"f{i}", day + dt.timedelta(minutes=i), day + dt.timedelta(minutes=i + 30)) for i in range(50)]) \
        .write.parquet(str(tmp_path / "points"))
    occupancy = occupancy_intervals(spark.read.parquet(str(tmp_path / "points")), ArrivalRules())
    plan = occupancy._jdf.queryExecution().toString()
    assert str(tmp_path / "points") not in plan  # the written instants are all that the sweep reads
    assert occupancy.count() == 80


def test_occupancy_lookup_over_long_intervals(spark):
    """A sentinel landing time and a gap of months, against a plain search."""
    day = dt.datetime(2024, 1, 1)
    flights = [("a", day, dt.datetime(9999, 12, 31)), ("b", day + dt.timedelta(days=100), day + dt.timedelta(days=100, hours=1)),
               ("c", day + dt.timedelta(minutes=5), day + dt.timedelta(minutes=50)), ("d", day + dt.timedelta(days=300), None)]
    occupancy = occupancy_intervals(_points(spark, flights), ArrivalRules())
    spans = [(r.dt_valid_from, r.dt_valid_to, r.nr_aircraft_in_tma) for r in occupancy.collect()]
    times = [day + dt.timedelta(minutes=m) for m in (-1, 0, 4, 5, 49, 50, 70, 60 * 24 * 50, 60 * 24 * 100, 60 * 24 * 100 + 61)]
    times += [dt.datetime(5000, 1, 1), dt.datetime(9999, 12, 31), None]
    rows = spark.createDataFrame(list(enumerate(times)), "k int, t timestamp_ntz")
    got = {r.k: r.nr_aircraft_in_tma for r in occupancy_at(rows, occupancy, "t", ArrivalRules()).collect()}
    assert got == {k: next((n for lo, hi, n in spans if t and hi and lo <= t < hi), None) for k, t in enumerate(times)}
