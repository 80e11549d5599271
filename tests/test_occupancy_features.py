import datetime as dt
import random

import pytest

from pyspark.sql import Window, functions as F

from skylane.config import ArrivalRules
from skylane.functions.timefns import time_bin
from skylane.operators import occupancy_at, occupancy_intervals, transit_moving_average
from skylane.operators.features import fuel_percentile
from skylane.operators.sequence import sweep
from tests.helpers import T

TMA = ("id string, dt_radar timestamp_ntz, nr_speed bigint, fl decimal(18,3), "
       "aircraft_type string, c_time timestamp_ntz, aldt timestamp_ntz")


def _tma(spark, flights):
    rows = [(i, c, 200, None, "X", c, a) for (i, c, a) in flights]
    return spark.createDataFrame(rows, TMA)


def test_shared_instant_first_and_settled(spark):  # T2
    t0, t1, t2 = T(2024, 1, 1, 10), T(2024, 1, 1, 11), T(2024, 1, 1, 12)
    tma = _tma(spark, [("A", t0, t1), ("B", t0, t2), ("C", t1, t2), ("D", t1, t2)])
    first = {r.dt_valid_from: r.nr_aircraft_in_tma
             for r in occupancy_intervals(tma, ArrivalRules()).collect()}
    settled = {r.dt_valid_from: r.nr_aircraft_in_tma
               for r in occupancy_intervals(tma, ArrivalRules(tie_rule="settled")).collect()}
    assert first == {t0: 1, t1: 1, t2: 2}
    assert settled == {t0: 2, t1: 3, t2: 0}


def _random_flights(seed, n=120):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        c = T(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(5 * 24 * 6) * 10)
        out.append((f"f{i}", c, c + dt.timedelta(minutes=rnd.choice([10, 30, 60, 150, 1500]))))
    return out


def test_occupancy_equals_single_window_and_tiles(spark):  # W4-W7 design, invariants
    tma = _tma(spark, _random_flights(3))
    for unit in ("hour", "day"):
        rules = ArrivalRules(tie_rule="settled", sweep_unit=unit)
        got = sorted(occupancy_intervals(tma, rules).collect())
        ev = (tma.select("id", F.col("c_time").alias("t"), F.lit(1).alias("d")).distinct()
              .unionByName(tma.select("id", F.col("aldt").alias("t"), F.lit(-1).alias("d")).distinct())
              .groupBy("t").agg(F.sum("d").alias("d")))
        w = Window.orderBy("t")
        ref = ev.select(F.row_number().over(w).cast("bigint").alias("id"),
                        F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))
                        .cast("bigint").alias("n"),
                        F.col("t"), F.lead("t").over(w).alias("to"))
        ref = sorted((r.id, r.n, r.t, r.to, r.to is None) for r in ref.collect())
        assert [tuple(r) for r in got] == ref, unit
        assert got[-1].nr_aircraft_in_tma == 0 and got[-1].is_current
        assert all(a.dt_valid_to == b.dt_valid_from for a, b in zip(got, got[1:]))


def test_sweep_with_keys(spark):
    rows = [("a", T(2024, 1, 1, h), 1) for h in range(5)] + [("b", T(2024, 1, 3, h), 2) for h in range(3)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    got = sweep(df, ["k"], "t", time_bin(F.col("t"), "hour"), "v", 1000).collect()
    got = sorted((r.k, r.row_num, r.running) for r in got)
    assert got == [("a", i + 1, i + 1) for i in range(5)] + [("b", i + 1, 2 * (i + 1)) for i in range(3)]


def test_binned_interval_join_equals_nested_loop(spark):  # D7 design, T15
    tma = _tma(spark, _random_flights(5))
    rules = ArrivalRules()
    occ = occupancy_intervals(tma, rules)
    rnd = random.Random(9)
    probes = [(f"p{i}", T(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(7 * 24 * 60)))
              for i in range(300)]
    last = max(r.dt_valid_from for r in occ.collect())
    probes += [("at_last", last), ("none", None)]
    pr = spark.createDataFrame(probes, "pid string, c_time timestamp_ntz")
    got = {r.pid: r.nr_aircraft_in_tma for r in occupancy_at(pr, occ, "c_time", rules).collect()}
    iv = [(r.dt_valid_from, r.dt_valid_to, r.nr_aircraft_in_tma) for r in occ.collect()]
    for pid, t in probes:
        want = [n for (a, b, n) in iv if t is not None and b is not None and a <= t < b]
        assert got[pid] == (want[0] if want else None), pid
    assert got["at_last"] is None


def test_moving_average_peers_and_horizon(spark):  # W8
    rows = [("a", T(2024, 1, 1, 0), 1.0), ("b", T(2024, 1, 1, 1), 3.0), ("c", T(2024, 1, 1, 1), 5.0),
            ("d", T(2024, 1, 1, 2, 0, 1), 7.0), ("n1", None, 2.0), ("n2", None, 4.0)]
    df = spark.createDataFrame(rows, "id string, aldt timestamp_ntz, transit_tma double") \
        .withColumn("drwy_validado", F.lit("28R")).withColumn("setor", F.lit("0"))
    got = {r.id: r.transit_tma_predicted
           for r in transit_moving_average(df, ArrivalRules()).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 3.0, "d": 7.0, "n1": 3.0, "n2": 3.0}


@pytest.mark.parametrize("hours", [1, 50])
def test_day_binned_moving_average_equals_plain(spark, hours):  # W8 design
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        t = None if i % 37 == 0 else T(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(4 * 86400))
        rows.append((f"f{i}", t, float(rnd.randrange(1000)), rnd.choice(["10L", "28R", None]),
                     rnd.choice(["0", "60"])))
    df = spark.createDataFrame(rows, "id string, aldt timestamp_ntz, transit_tma double, "
                                     "drwy_validado string, setor string")
    got = sorted((r.id, r.transit_tma_predicted)
                 for r in transit_moving_average(df, ArrivalRules(horizon_seconds=hours * 3600)).collect())
    df.createOrReplaceTempView("mv")
    ref = spark.sql(f"""SELECT id, avg(transit_tma) OVER (PARTITION BY drwy_validado, setor
                       ORDER BY aldt RANGE BETWEEN INTERVAL '{hours}' HOUR PRECEDING AND CURRENT ROW) AS p
                       FROM mv""").collect()
    ref = sorted((r.id, r.p) for r in ref)
    assert [(a, round(b, 9)) for a, b in got] == [(a, round(b, 9)) for a, b in ref]


def test_percentile_linear_interpolation_ignores_nulls(spark):  # A4
    df = spark.createDataFrame([("A", "X", "1", v) for v in (1.0, 2.0, None, 10.0)],
                               "adep string, aircraft string, drwy_validado string, consumption_kg double")
    assert fuel_percentile(df, ArrivalRules()).collect()[0].consumption_20p == 1.4


def test_range_percentile_equals_hash_percentile(spark):  # A4 at scale
    from skylane.operators.percentile import exact_percentile
    rnd = random.Random(5)
    rows = [("hot", "X", "1", rnd.choice([None, float(rnd.randrange(50))])) for _ in range(3000)]
    rows += [(f"g{i % 40}", "Y", rnd.choice(["2", None]), float(rnd.randrange(1000)) / 7)
             for i in range(600)]
    rows += [("nulls", "Z", "3", None)] * 3 + [("one", "Z", "3", 4.5)]
    df = spark.createDataFrame(rows, "adep string, aircraft string, drwy_validado string, v double") \
        .repartition(6)
    for p in (0.0, 0.2, 0.5, 0.99, 1.0):
        args = (df, ["adep", "aircraft", "drwy_validado"], "v", p, "q", None, 10, 1000)
        a = sorted(exact_percentile(*args, method="hash").collect(), key=repr)
        b = sorted(exact_percentile(*args, method="range").collect(), key=repr)
        assert a == b, p


def test_ranked_percentile_spreads_a_hot_group(spark):
    """Range partitioning splits one group holding most rows over several tasks."""
    rows = [("hot", "X", "1", float(i)) for i in range(4000)] + [("cold", "X", "1", 1.0)]
    df = spark.createDataFrame(rows, "adep string, aircraft string, drwy_validado string, v double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # planned placement, no coalescing
    try:
        placed = (df.select(F.struct("adep", "aircraft", "drwy_validado").alias("_g"), "v")
                  .repartitionByRange("_g", "v")
                  .where(F.col("_g.adep") == "hot")
                  .select(F.spark_partition_id().alias("p")).distinct().count())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert placed > 1
    from skylane.operators.percentile import exact_percentile
    got = {r.adep: r.q for r in exact_percentile(
        df, ["adep", "aircraft", "drwy_validado"], "v", 0.2, "q", None, 10, 1000,
        method="range").collect()}
    assert got == {"hot": 0.2 * 3999, "cold": 1.0}


def test_keyed_sweeps_and_lookups_are_independent(spark):
    """``keys`` (e.g. an airport column) give one sweep and one lookup per key."""
    rnd = random.Random(21)
    rows = []
    for i in range(90):
        ap = rnd.choice(["AAAA", "BBBB"])
        c = T(2024, 1, 1) + dt.timedelta(minutes=10 * rnd.randrange(3 * 24 * 6))
        rows.append((ap, f"f{i}", c, c + dt.timedelta(minutes=rnd.choice([10, 40, 300]))))
    tma = spark.createDataFrame(
        [(ap, i, c, 1, None, "X", c, a) for ap, i, c, a in rows],
        "ap string, " + TMA)
    rules = ArrivalRules(tie_rule="settled")
    occ = occupancy_intervals(tma, rules, keys=["ap"])
    got = sorted(tuple(r) for r in occ.collect())
    for ap in ("AAAA", "BBBB"):
        one = occupancy_intervals(tma.where(F.col("ap") == ap).drop("ap"), rules)
        assert [g[1:] for g in got if g[0] == ap] == sorted(tuple(r) for r in one.collect())
    probes = [(rnd.choice(["AAAA", "BBBB"]),
               T(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(4 * 24 * 60))) for _ in range(200)]
    pr = spark.createDataFrame([(ap, f"p{i}", t) for i, (ap, t) in enumerate(probes)],
                               "ap string, pid string, c_time timestamp_ntz")
    res = {r.pid: r.nr_aircraft_in_tma
           for r in occupancy_at(pr, occ, "c_time", rules, keys=["ap"]).collect()}
    iv = [(r.ap, r.dt_valid_from, r.dt_valid_to, r.nr_aircraft_in_tma) for r in occ.collect()]
    for i, (ap, t) in enumerate(probes):
        want = [n for (k, a, b, n) in iv if k == ap and b is not None and a <= t < b]
        assert res[f"p{i}"] == (want[0] if want else None)
