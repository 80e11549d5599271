"""Joins with heavy keys, with adaptive execution off."""
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from skylane.config import ArrivalRules
from skylane.operators import radar_in_terminal_area
from skylane.plans.skew import bounded_join, heavy_keys, split_join

ROWS, TASKS = 240_000, 8


@contextmanager
def plain_shuffles(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": str(TASKS)}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def points(spark):
    """A third of all rows under one key, the others spread; some NULL keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)) \
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(ROWS).select(key.alias("k"), (F.col("id") % 2).cast("int").alias("d"), F.col("id").alias("v"))


def sides(spark):
    left = points(spark).withColumn("d", F.lit(0))
    right = left.select("k", "d").distinct().where("k IS NULL OR k <> 'k4'").withColumn("w", F.xxhash64("k"))
    return left, right.unionByName(spark.createDataFrame([(None, 0, 1), ("hot", 0, 2), ("absent", 0, 3)],
                                                         "k string, d int, w long"))


def task_rows(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_third_of_the_rows_under_one_key_fills_no_task(spark):
    with plain_shuffles(spark):
        left, right = sides(spark)
        once = right.dropDuplicates(["k"])
        plain, split = (task_rows(j) for j in (left.join(once, ["k", "d"]), split_join(left, once, ["k", "d"])))
        assert sum(plain) == sum(split)
        assert plain[-1] > 2.5 * plain[len(plain) // 2]
        assert len(split) == TASKS and split[-1] < 1.5 * split[len(split) // 2]
        plan = split_join(left, once, ["k", "d"])._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_the_plain_join(spark, how):
    with plain_shuffles(spark):
        left, right = sides(spark)
        plain, split = left.join(right, ["k", "d"], how), split_join(left, right, ["k", "d"], how)
        assert split.columns == plain.columns
        digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
        assert digest(split) == digest(plain)


def test_heavy_keys_are_few_and_the_rest_is_a_plain_join(spark):
    found = heavy_keys(points(spark), ["k"], TASKS)
    assert [len(h) for h in found.values()] == [1]
    even = spark.range(10_000).select((F.col("id") % 1000).alias("k"))
    assert heavy_keys(even, ["k"], TASKS) == {} and heavy_keys(even.limit(0), ["k"], TASKS) == {}
    assert split_join(even.limit(0), even, ["k"]).count() == 0
    assert bounded_join(even, even.distinct(), ["k"], "inner", None, 10).count() == 10_000
    with pytest.raises(ValueError, match="types"):
        split_join(even, even.select(F.col("k").cast("string")), ["k"])
    with pytest.raises(ValueError, match="how"):
        split_join(even, even, ["k"], "full")


def test_a_busy_callsign_is_split(spark):
    """Radar points of which a third are of one flight, beyond the broadcast bound."""
    flights = spark.sql("""SELECT concat('F', id) AS flight_id, DATE'2024-01-01' AS flight_date, concat('2024-01-01F', id) AS id,
        'A320' AS aircraft_type, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS entry_time,
        TIMESTAMP_NTZ'2024-01-01 23:00:00' AS landing_time FROM range(2000)""")
    radar = spark.sql("""SELECT DATE'2024-01-01' AS radar_date, cast(id % 400 AS bigint) AS aircraft_speed,
        cast(id % 90 AS decimal(18,3)) AS flight_level, if(id % 3 = 0, 'F7', concat('F', id % 2500)) AS flight_id,
        timestampadd(SECOND, cast(id % 86000 AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS radar_timestamp
        FROM range(120000)""")
    with plain_shuffles(spark):
        few, many = (radar_in_terminal_area(flights, radar, ArrivalRules(broadcast_max_rows=n)) for n in (1_000_000, -1))
        plan = many._jdf.queryExecution().executedPlan().toString()
        assert "_part" in plan and "Broadcast" not in plan
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
