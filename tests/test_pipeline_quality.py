import os
import tempfile

from pyspark.sql import functions as F

from skylane.config import ArrivalRules
from skylane.operators.quality import (
    ENTRY_BEFORE_LANDING, ColumnCheck, custom_report, non_empty, orphan_keys, run_checks,
)
from skylane.plans.pipeline import build_layers, run_pipeline
from skylane.sources import Sources
from skylane.sources.fixture import fixture_sources
from skylane.sources.readers import read_flight_records, read_radar_points
from tests.helpers import T, chart_df, flight, flights_df, radar, radar_df

CHART = [("A320", 10.0, lv, lv / 1000.0) for lv in range(0, 420, 10)]


def _sources(spark):
    flights = [flight(c_time=T(2024, 1, 1, 10), aldt=T(2024, 1, 1, 11)),                # leg 1
               flight(c_time=T(2024, 1, 1, 14), aldt=T(2024, 1, 1, 15)),                # leg 2, same key
               flight(fltid="TAM2", c_time=T(2024, 1, 1, 12), aldt=T(2024, 1, 1, 13))]  # no radar
    pts = [radar("TAM1", 100.0 - m, 250, T(2024, 1, 1, 14, m)) for m in range(0, 30, 3)]
    return Sources(flights_df(spark, flights), radar_df(spark, pts), chart_df(spark, CHART))


def test_consumption_key_and_feature_fan_out(spark):  # T5, T6
    rules = ArrivalRules(min_points=1)
    layers = build_layers(_sources(spark), rules)
    cons = layers["flight_consumption"].collect()
    assert sorted(r.id or "-" for r in cons) == ["-", "2024-01-01TAM1", "2024-01-01TAM1"]
    kept = build_layers(_sources(spark), rules.with_(keep_flight_id=True))["flight_consumption"]
    assert sorted(r.id for r in kept.collect()) == ["2024-01-01TAM1", "2024-01-01TAM1", "2024-01-01TAM2"]
    feats = build_layers(_sources(spark), rules.with_(row_preserving=False))["ml_features"].collect()
    assert len(feats) == 5 and sum(r.id is None for r in feats) == 1
    assert all(r.transit_tma_predicted is None for r in feats if r.id is None)
    rp = layers["ml_features"].collect()
    assert len(rp) == 3 and all(r.transit_tma_predicted is not None for r in rp)
    assert all(r.kpi16 == r.consumption_kg - r.consumption_20p for r in feats if r.kpi16 is not None)


def test_checks_one_row_per_check(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (None, "b", -1.0), (3, "b", 2.0), (3, None, 0.0)],
                               "k int, s string, v double")
    checks = [ColumnCheck("t", "k", "not_null"), ColumnCheck("t", "k", "unique"),
              ColumnCheck("t", "v", "positive"), ColumnCheck("t", "s", "accepted_values", ("a",))]
    got = {(r.column_name, r.check_name): (r.failed_rows, r.passed)
           for r in run_checks({"t": df}, checks).collect()}
    assert got == {("k", "not_null"): (1, False), ("k", "unique"): (1, False),
                   ("v", "positive"): (2, False), ("s", "accepted_values"): (2, False)}


def test_custom_checks(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    dim = spark.createDataFrame([("a",)], "id string")
    empty = spark.createDataFrame([], "id string")
    rep = {r.check_name: r.failed_rows for r in custom_report({
        "orphans": orphan_keys(fact, dim), "nonempty": non_empty(fact),
        "empty": non_empty(empty)}).collect()}
    assert rep == {"orphans": 2, "nonempty": 0, "empty": 1}


def test_row_rule_entry_before_landing(spark):  # Q7
    layers = build_layers(_sources(spark), ArrivalRules(min_points=1))
    r = run_checks(layers, [ENTRY_BEFORE_LANDING]).collect()[0]
    assert r.failed_rows == 0 and r.passed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_nested_loops_or_python(spark):
    layers = build_layers(fixture_sources(spark, "/root/testdata/sf0.001"), ArrivalRules(min_points=3),
                          materialize="none")  # the whole plan, not checkpoint scans
    for name in ("radar_in_terminal_area", "vertical_profile", "occupancy", "flight_consumption",
                 "ml_features"):
        plan = _plan(layers[name])
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                    "ArrowEvalPython", "FlatMapGroupsInPandas"):
            assert bad not in plan, (name, bad)
    # the profile never gathers everything into one partition
    assert "SinglePartition" not in _plan(layers["vertical_profile"])


def test_sources_prune_partitions_and_push_filters(spark):
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    base = tempfile.mkdtemp(prefix="skylane-src-")
    src.radar.withColumn("ingestion_date", F.to_date("dt_radar")).write.partitionBy(
        "ingestion_date").parquet(os.path.join(base, "radar"))
    src.flights.withColumn("ingestion_date", F.to_date("aldt")).write.partitionBy(
        "ingestion_date").parquet(os.path.join(base, "flights"))
    import datetime as dt
    radar = read_radar_points(spark, os.path.join(base, "radar"), start=dt.date(2024, 1, 2))
    flights = read_flight_records(spark, os.path.join(base, "flights"))
    layers = build_layers(Sources(flights, radar, src.chart), ArrivalRules(min_points=3),
                          materialize="none")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # untruncated filter lists
    plan = _plan(layers["radar_in_terminal_area"])
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert "EqualTo(ades,SBGR)" in plan and "EqualTo(c,100)" in plan
    assert "StringStartsWith(adep,SB)" in plan and "In(type, [" in plan
    assert "IsNotNull(ds_registration)" in plan and "Not(EqualTo(ds_registration,NULL))" in plan
    assert "IsNotNull(nr_flightlevel)" in plan and "IsNotNull(nr_speed)" in plan
    assert "GreaterThanOrEqual(dt_radar," in plan and "LessThanOrEqual(dt_radar," in plan
    assert layers["radar_in_terminal_area"].count() > 0


def test_run_pipeline_writes_tables(spark):
    out = tempfile.mkdtemp(prefix="skylane-out-")
    layers = run_pipeline(fixture_sources(spark, "/root/testdata/sf0.001"),
                          ArrivalRules(min_points=3), out)
    back = spark.read.parquet(os.path.join(out, "ml_features"))
    assert back.count() == layers["ml_features"].count() > 0
    assert dict(spark.read.parquet(os.path.join(out, "fct_flight_transit_metrics")).dtypes)["kpi08"] == "double"


def test_occupancy_written_in_time_order(spark):  # O1
    out = tempfile.mkdtemp(prefix="skylane-out-")
    run_pipeline(fixture_sources(spark, "/root/testdata/sf0.001"), ArrivalRules(min_points=3), out)
    occ = spark.read.parquet(os.path.join(out, "occupancy"))
    rows = occ.collect()  # files are read in order for a single sorted table
    times = [r.dt_valid_from for r in rows]
    assert times == sorted(times) and [r.id for r in rows] == list(range(1, len(rows) + 1))


def test_jdbc_export_replaces_table(spark, monkeypatch):  # S6
    from pyspark.sql.readwriter import DataFrameWriter
    from skylane.sources.sinks import export_jdbc
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc",
                        lambda self, url, table, mode=None, properties=None:
                        calls.append((url, table, mode, properties)))
    export_jdbc(spark.range(3), "jdbc:postgresql://db/x", "flight_consumption_ml_ready",
                {"user": "u"}, max_connections=4)
    url, table, mode, props = calls[0]
    assert (url, table, mode) == ("jdbc:postgresql://db/x", "flight_consumption_ml_ready", "overwrite")
    assert props == {"user": "u", "batchsize": "10000", "truncate": "false", "numPartitions": "4"}


def test_layers_as_sql_views(spark):  # ad-hoc queries on the tables
    layers = build_layers(fixture_sources(spark, "/root/testdata/sf0.001"), ArrivalRules(min_points=3))
    assert layers.register_views(["ml_features"], prefix="t_") == ["t_ml_features"]
    n = spark.sql("SELECT count(*) AS n FROM t_ml_features").first().n
    assert n == layers["ml_features"].count() > 0


def test_run_pipeline_writes_and_enforces_checks(spark):
    from skylane.plans.pipeline import DataQualityError
    out = tempfile.mkdtemp(prefix="skylane-out-")
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    run_pipeline(src, ArrivalRules(min_points=3), out)
    cols = spark.read.parquet(os.path.join(out, "dq_columns"))
    assert cols.count() == 70 and spark.read.parquet(os.path.join(out, "dq_custom")).count() == 3
    if cols.where("NOT passed").count():  # the driver tables do fail some checks
        import pytest
        with pytest.raises(DataQualityError):
            run_pipeline(src, ArrivalRules(min_points=3), tempfile.mkdtemp(prefix="skylane-out-"),
                         fail_on_check=True)


def test_single_partition_only_over_the_day_table(spark):
    layers = build_layers(fixture_sources(spark, "/root/testdata/sf0.001"), ArrivalRules(min_points=3))
    occ = layers.plan("occupancy")._jdf.queryExecution().executedPlan().toString()
    lines = occ.split("\n")
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1
    # directly below it: the per-segment summary aggregate (one row per day)
    below = "\n".join(lines[single[0]:single[0] + 4])
    assert "_seg" in below and "Aggregate" in below
    for name in ("vertical_profile", "ml_features", "radar_in_terminal_area"):
        assert "SinglePartition" not in layers.plan(name)._jdf.queryExecution().executedPlan().toString()


def test_command_line_run(spark):
    """The entry point reads real Parquet/CSV sources and writes every table."""
    from skylane.__main__ import main
    src = fixture_sources(spark, "/root/testdata/sf0.001")
    base = tempfile.mkdtemp(prefix="skylane-cli-")
    src.flights.withColumn("ingestion_date", F.to_date("aldt")).write.partitionBy(
        "ingestion_date").parquet(os.path.join(base, "kpi"))
    src.radar.withColumn("ingestion_date", F.to_date("dt_radar")).write.partitionBy(
        "ingestion_date").parquet(os.path.join(base, "radar"))
    src.chart.coalesce(1).write.option("header", True).csv(os.path.join(base, "chart"))
    out = os.path.join(base, "out")
    main(["--flights", os.path.join(base, "kpi"), "--radar", os.path.join(base, "radar"),
          "--chart", os.path.join(base, "chart"), "--out", out, "--min-points", "3"], spark)
    want = run_pipeline(src, ArrivalRules(min_points=3),
                        tempfile.mkdtemp(prefix="skylane-out-"))["ml_features"].count()
    assert spark.read.parquet(os.path.join(out, "ml_features")).count() == want > 0


def _failing(spark):
    """Sources whose flights break a check of a written table (a NULL transit)."""
    s = _sources(spark)
    bad = flights_df(spark, [flight(fltid="TAM3", transito=None, c_time=T(2024, 1, 1, 12),
                                    aldt=T(2024, 1, 1, 13))])
    return Sources(s.flights.unionByName(bad), s.radar, s.chart)


def _passing(spark):
    flights = [flight(c_time=T(2024, 1, 1, 14), aldt=T(2024, 1, 1, 15))]
    return Sources(flights_df(spark, flights), _sources(spark).radar, _sources(spark).chart)


def test_failing_check_leaves_the_published_tables(spark):  # write, audit, publish
    import pytest
    from skylane.plans.pipeline import OUTPUTS, DataQualityError
    from skylane.sources import Versions, read_published
    rules = ArrivalRules(min_points=1)
    for versioned in (False, True):
        out = tempfile.mkdtemp(prefix="skylane-out-")
        run_pipeline(_passing(spark), rules, out, versioned=versioned)
        read = (lambda t: read_published(spark, out, t)) if versioned else (
            lambda t: spark.read.parquet(os.path.join(out, t)))
        before = {t: sorted(map(str, read(t).collect())) for t in OUTPUTS}
        with pytest.raises(DataQualityError, match="flights_filtered"):
            run_pipeline(_failing(spark), rules, out, fail_on_check=True, versioned=versioned)
        assert {t: sorted(map(str, read(t).collect())) for t in OUTPUTS} == before
    assert len(Versions(spark, out).all()) == 2 and len(Versions(spark, out).published()) == 1


def test_killed_run_leaves_the_published_version(spark, monkeypatch):
    import pytest
    from skylane.plans import pipeline
    from skylane.sources import read_published
    out = tempfile.mkdtemp(prefix="skylane-out-")
    rules = ArrivalRules(min_points=1)
    run_pipeline(_passing(spark), rules, out, versioned=True)
    n = read_published(spark, out, "ml_features").count()
    monkeypatch.setattr(pipeline, "ml_features", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_pipeline(_sources(spark), rules, out, versioned=True)
    assert read_published(spark, out, "ml_features").count() == n == 1
    assert read_published(spark, out, "dim_flight_identifiers").count() == 1


def test_checks_of_the_write_equal_the_report(spark):
    from skylane.plans.pipeline import quality_report
    src, rules = fixture_sources(spark, "/root/testdata/sf0.001"), ArrivalRules(min_points=3)
    out = tempfile.mkdtemp(prefix="skylane-out-")
    run_pipeline(src, rules, out)
    for name, want in zip(("dq_columns", "dq_custom"), quality_report(build_layers(src, rules))):
        got = spark.read.parquet(os.path.join(out, name))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_large_tables_are_stored_by_day(spark):
    out = tempfile.mkdtemp(prefix="skylane-out-")
    layers = run_pipeline(fixture_sources(spark, "/root/testdata/sf0.001"),
                          ArrivalRules(min_points=3), out)
    for name in ("radar_in_terminal_area", "fuel_at_points", "vertical_profile"):
        table = spark.read.parquet(os.path.join(out, name))
        assert table.where(F.col("radar_date") != F.to_date("dt_radar")).isEmpty()
        day = table.first().radar_date
        plan = _plan(table.where(F.col("radar_date") == F.lit(day)))
        assert "PartitionFilters: [isnotnull(radar_date" in plan
        assert "radar_date" not in layers[name].columns
