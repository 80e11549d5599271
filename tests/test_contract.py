"""Contract queries vs their DuckDB oracle on the driver tables (subset; the
full list runs with ``python tests/oracle_compare.py``)."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", ["flights_filtered", "radar_in_terminal_area", "vertical_profile",
                                  "occupancy_first", "flight_consumption", "ml_features",
                                  "dq_report"])
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)


def test_every_query_has_an_oracle():
    """Of the analytics; the optional training-data queries are compared apart."""
    from skylane.plans.contract import QUERIES
    from skylane.plans.oracle import oracle_sql
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 19 and df.count() >= 0


SCALE_PATH_QUERIES = ["radar_in_terminal_area", "radar_cross_midnight", "vertical_profile",
                      "vertical_profile_own_level", "flight_fuel", "occupancy_first",
                      "occupancy_settled", "occupancy_at_entry", "flight_consumption",
                      "fuel_p20", "transit_moving_avg", "ml_features", "ml_features_key_join",
                      "dq_custom"]


@pytest.fixture()
def scale_paths(spark, monkeypatch):
    """No broadcast and no in-task percentile anywhere: the plans that run when
    flight-level tables exceed their bounds; finer sequence segments."""
    import skylane.plans.contract as contract
    monkeypatch.setattr(contract, "CONTRACT_RULES", contract.CONTRACT_RULES.with_(
        broadcast_max_rows=-1, group_max_rows=-1, profile_unit="minute", sweep_unit="hour",
        interval_unit="minute"))
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", SCALE_PATH_QUERIES)
def test_scale_paths_match_oracle(spark, con, scale_paths, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "BroadcastHashJoin" not in plan
    assert compare(spark, con, name, lambda s, d: df, E.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", ["radar_in_terminal_area", "occupancy_first", "ml_features"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    """Zone-less timestamps throughout: a DST session zone changes nothing."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
