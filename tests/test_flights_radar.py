import datetime as dt

from skylane.config import ArrivalRules
from skylane.operators import (
    enrich_flights, filter_arrivals, latest_flight_per_key, radar_in_terminal_area,
    stage_flights, stage_radar,
)
from tests.helpers import T, flight, flights_df, radar, radar_df

RULES = ArrivalRules(min_points=1)


def _filtered(spark, rows):
    return filter_arrivals(enrich_flights(stage_flights(flights_df(spark, rows))), RULES)


def test_sector_imputation(spark):  # N1, T1
    rows = [flight(fltid="A", setor=None, bear=125.5), flight(fltid="B", setor=None, bear=360.0),
            flight(fltid="C", setor=None, bear=None), flight(fltid="D", setor=2.5),
            flight(fltid="E", setor=3.5), flight(fltid="F", setor=None, bear=-10.0)]
    e = enrich_flights(stage_flights(flights_df(spark, rows)))
    got = {r.flight_id: r.setor for r in e.collect()}
    assert got == {"A": "120", "B": "360", "C": None, "D": "2", "E": "4", "F": "-60"}


def test_key_and_transit(spark):  # P10, X13
    e = enrich_flights(stage_flights(flights_df(spark, [
        flight(desimp="00:10:00", kpi08="-00:01:30")]))).collect()[0]
    assert e.id == "2024-01-01TAM1"
    assert e.transit_tma == dt.timedelta(seconds=510)


def test_arrival_filter(spark):  # N2
    rows = [flight(fltid="ok"), flight(fltid="dest", ades="SBSP"), flight(fltid="radius", c=40),
            flight(fltid="kpi", kpi08=None), flight(fltid="origin", adep="KMIA"),
            flight(fltid="type", type="C172"), flight(fltid="sector", bear=None)]
    assert [r.flight_id for r in _filtered(spark, rows).collect()] == ["ok"]


def test_latest_flight_tie_break(spark):  # W1, T3
    rows = [flight(c_time=T(2024, 1, 1, 10, 30), aldt=T(2024, 1, 1, 11), type="A321"),
            flight(c_time=T(2024, 1, 1, 10, 0), aldt=T(2024, 1, 1, 11), type="A320"),
            flight(c_time=T(2024, 1, 1, 5, 0), aldt=T(2024, 1, 1, 6), type="B738")]
    got = latest_flight_per_key(_filtered(spark, rows)).collect()
    assert len(got) == 1 and got[0].entry_time == T(2024, 1, 1, 10, 0)


def test_radar_window_and_first_point_per_level(spark):  # N3, W2, F5, F6
    f = _filtered(spark, [flight(c_time=T(2024, 1, 1, 10), aldt=T(2024, 1, 1, 11))])
    pts = [radar("TAM1", 100.0, 250, T(2024, 1, 1, 10, 5)),
           radar("TAM1", 100.0, 240, T(2024, 1, 1, 10, 5)),   # same time, lower speed wins
           radar("TAM1", 100.0, 200, T(2024, 1, 1, 10, 6)),
           radar("TAM1", 90.0, 230, T(2024, 1, 1, 11, 0)),    # landing instant included
           radar("TAM1", 80.0, 230, T(2024, 1, 1, 11, 1)),    # after landing
           radar("TAM1", 70.0, 230, T(2024, 1, 1, 9, 59)),    # before entry
           radar("NULL", 60.0, 230, T(2024, 1, 1, 10, 10)),
           radar("TAM1", None, 230, T(2024, 1, 1, 10, 11)),
           radar("TAM1", 50.0, None, T(2024, 1, 1, 10, 12))]
    out = radar_in_terminal_area(f, stage_radar(radar_df(spark, pts)), RULES).collect()
    got = sorted((float(r.fl), r.dt_radar, r.nr_speed) for r in out)
    assert got == [(90.0, T(2024, 1, 1, 11, 0), 230), (100.0, T(2024, 1, 1, 10, 5), 240)]
    assert {r.id for r in out} == {"2024-01-01TAM1"}


def test_cross_midnight(spark):  # T7
    f = _filtered(spark, [flight(c_time=T(2024, 1, 1, 23, 50), aldt=T(2024, 1, 2, 0, 10))])
    pts = radar_df(spark, [radar("TAM1", 100.0, 250, T(2024, 1, 1, 23, 55)),
                           radar("TAM1", 90.0, 250, T(2024, 1, 2, 0, 5))])
    faithful = radar_in_terminal_area(f, stage_radar(pts), RULES).collect()
    assert [r.dt_radar for r in faithful] == [T(2024, 1, 2, 0, 5)]
    both = radar_in_terminal_area(f, stage_radar(pts), RULES.with_(cross_midnight=True)).collect()
    assert sorted(r.dt_radar for r in both) == [T(2024, 1, 1, 23, 55), T(2024, 1, 2, 0, 5)]
    assert {r.id for r in both} == {"2024-01-02TAM1"}


def test_window_of_many_years_is_one_row(spark):
    """An entry dated 1900: the window is met by callsign, no day is listed, and
    points of all its days and of ordinary windows are found."""
    rows = [flight(c_time=T(1900, 1, 1), aldt=T(2024, 1, 2, 0, 10)),
            flight(fltid="TAM2", c_time=T(2024, 1, 1, 23, 50), aldt=T(2024, 1, 2, 0, 10))]
    f = _filtered(spark, rows)
    pts = radar_df(spark, [radar("TAM1", 100.0, 250, T(2023, 6, 1, 1)), radar("TAM1", 100.0, 250, T(2023, 6, 1, 2)),
                           radar("TAM1", 90.0, 250, T(2024, 1, 2, 0, 11)), radar("TAM2", 80.0, 1, T(2024, 1, 1, 23, 55)),
                           radar("TAM2", 70.0, 1, T(2024, 1, 1, 23, 45))])
    rules = RULES.with_(cross_midnight=True)
    for limit in (1_000_000, -1):
        out = radar_in_terminal_area(f, stage_radar(pts), rules.with_(broadcast_max_rows=limit))
        assert sorted((r.id, float(r.fl), r.dt_radar) for r in out.collect()) == [
            ("2024-01-02TAM1", 100.0, T(2023, 6, 1, 1)), ("2024-01-02TAM2", 80.0, T(2024, 1, 1, 23, 55))]
    joined = out._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("Generate explode") == 1


def test_packed_order_of_time_and_speed(spark):
    """The packed number sorts like (time, speed) and gives both back, for any
    64-bit speed and times before 1970."""
    from pyspark.sql import functions as F
    from skylane.operators.radar import packed_order, unpacked_order
    times = [T(1, 1, 1), T(1900, 3, 1), T(1969, 12, 31, 23, 59, 59, 999999), T(1970, 1, 1), T(2024, 5, 6, 7, 8, 9, 10), T(9999, 12, 31)]
    speeds = [-(1 << 63), -5, 0, 250, (1 << 63) - 1]
    df = spark.createDataFrame([(t, s) for t in times for s in speeds], "t timestamp_ntz, s bigint")
    packed = df.withColumn("k", packed_order(F.col("t"), F.col("s")))
    back = unpacked_order(F.col("k"), df.schema["s"].dataType)
    rows = packed.select("t", "s", "k", back[0].alias("t2"), back[1].alias("s2")).collect()
    assert all((r.t, r.s) == (r.t2, r.s2) for r in rows)
    assert [(r.t, r.s) for r in sorted(rows, key=lambda r: r.k)] == sorted((r.t, r.s) for r in rows)


def test_first_point_is_a_hash_aggregate(spark):
    from skylane.plans.pipeline import build_layers
    from skylane.sources.fixture import fixture_sources
    for cross in (False, True):
        layers = build_layers(fixture_sources(spark, "/root/testdata/sf0.001"), RULES.with_(cross_midnight=cross))
        plan = layers.plan("radar_in_terminal_area")._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
