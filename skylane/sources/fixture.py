"""Stand-in inputs built from the driver's test tables.

The test data holds no flights, so the three inputs are projected from
``events`` (radar points, and flights grouped by callsign/day/leg) and
``part`` (fuel chart).  These functions only shape rows into the source
schemas; every analytical step then runs on them through the library.
Expressions are timezone-free (timestamp_ntz arithmetic only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylane.sources.readers import Sources

# Fixed values of the fixture: aircraft type per callsign digit (index = digit).
FIXTURE_TYPES = ("A320", "A321", "B738", "B38M", "A20N", "A319", "A21N", "E195", "B737")
FIXTURE_FLIGHT_OTHER_TYPE = "C172"
FIXTURE_CHART_OTHER_TYPE = "B734"


def _trunc_minute(ts: Column) -> Column:
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.minute(ts), F.lit(0))


def _trunc_hour(ts: Column) -> Column:
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.lit(0), F.lit(0))


def _type_by_digit(d: Column, other: str) -> Column:
    expr = F.lit(other)
    for i in reversed(range(len(FIXTURE_TYPES))):
        expr = F.when(d == i, F.lit(FIXTURE_TYPES[i])).otherwise(expr)
    return expr


def fixture_radar(events: DataFrame) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    return events.select(
        F.when(eid % 97 == 0, F.lit("NULL"))
         .when(eid % 89 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("TAM"), (uid % 10).cast("string"))).alias("ds_registration"),
        F.when(eid % 83 == 0, F.lit(None).cast("double"))
         .otherwise(F.floor(F.least(F.col("value"), F.lit(400.0)) * 2) / 2).alias("nr_flightlevel"),
        F.when(eid % 79 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.lit(150) + eid % 300).cast("bigint").alias("nr_speed"),
        _trunc_minute(F.col("ts")).alias("dt_radar"),
    )


def fixture_flights(events: DataFrame) -> DataFrame:
    k = (F.col("user_id") % 10).alias("k")
    d = F.col("ts").cast("date").alias("d")
    leg = F.when((F.col("user_id") % 10 < 2) & (F.hour("ts") >= 12), 1).otherwise(0).alias("leg")
    g = events.groupBy(k, d, leg).agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min("event_id").alias("e"))
    k, e = F.col("k"), F.col("e")
    midnight_t1 = F.make_timestamp_ntz(F.year("t1"), F.month("t1"), F.dayofmonth("t1"),
                                       F.lit(0), F.lit(0), F.lit(0))
    return g.select(
        F.concat(F.lit("TAM"), k.cast("string")).alias("fltid"),
        F.when(e % 13 == 0, F.lit("KMIA"))
         .otherwise(F.concat(F.lit("SB"), (e % 4).cast("string"))).alias("adep"),
        F.when(e % 17 == 0, F.lit("SBSP")).otherwise(F.lit("SBGR")).alias("ades"),
        _type_by_digit(k, FIXTURE_FLIGHT_OTHER_TYPE).alias("type"),
        F.concat(F.lit("PR-"), k.cast("string")).alias("reg"),
        F.when((k == 3) & (e % 2 == 0), F.lit(None).cast("string"))
         .when(e % 5 == 0, F.lit("10L")).otherwise(F.lit("28R")).alias("drwy_validado"),
        F.when(e % 29 == 0, F.lit(None).cast("double"))
         .otherwise((e * 37 % 360).cast("double")).alias("bear"),
        F.when(e % 3 == 0, (F.floor((e * 37 % 360) / 60) * 60).cast("double")).alias("setor"),
        _trunc_hour(F.col("t0")).alias("c_time"),
        F.when(e % 11 == 0, 40).otherwise(100).cast("int").alias("c"),
        F.when(e % 23 == 0, F.timestamp_add("HOUR", F.lit(25), midnight_t1))
         .otherwise(_trunc_hour(F.col("t1"))).alias("aldt"),
        (F.lit(600) + e % 900).cast("double").alias("transito"),
        F.concat(F.lit("00:"), (F.lit(10) + e % 20).cast("string"), F.lit(":00")).alias("desimp"),
        F.when(e % 19 == 0, F.lit(None).cast("string"))
         .when(e % 7 == 0, F.lit("-00:01:30"))
         .otherwise(F.concat(F.lit("00:"), F.lpad((e % 30).cast("string"), 2, "0"), F.lit(":15")))
         .alias("kpi08"),
    )


def fixture_chart(part: DataFrame) -> DataFrame:
    g = part.groupBy((F.col("p_partkey") % 10).alias("a"), F.col("p_size")).agg(
        F.min("p_retailprice").alias("price"))
    return g.select(
        _type_by_digit(F.col("a"), FIXTURE_CHART_OTHER_TYPE).alias("aircraft"),
        (F.col("price") / 10).alias("tas_ms"),
        ((F.col("p_size") - 1) * 10).cast("int").alias("fl"),
        (F.col("price") / 1000).alias("fuel_flow_kg_s"),
    )


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return Sources(flights=fixture_flights(events), radar=fixture_radar(events),
                   chart=fixture_chart(part))
