import os

from pyspark.sql import functions as F

from skylane.plans.strategy import materialize, release_tables
from skylane.sources.sinks import write_table


def test_partitioned_table_has_few_files_per_directory(spark, tmp_path):
    df = spark.range(20_000).repartition(24).select("id", (F.col("id") % 4).alias("day"))
    write_table(df, str(tmp_path / "t"), ["day"])
    for day in range(4):
        assert len([f for f in os.listdir(tmp_path / "t" / f"day={day}") if f.endswith(".parquet")]) <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


def test_release_removes_the_intermediate_tables(spark):
    release_tables(spark)
    table = materialize(spark.range(5), name="probe")
    path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(path) and table.count() == 5
    assert release_tables(spark) == 1 and not os.path.exists(path)
    assert release_tables(spark) == 0


def _files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_a_hot_day_is_split_without_adaptive_execution(spark, tmp_path):
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    df = spark.range(60_000).repartition(24).select("id", day.alias("day"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_table(df, str(tmp_path / "t"), ["day"], parts=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = spark.read.parquet(str(tmp_path / "t")).where("day = 0").groupBy(
        F.input_file_name()).count().collect()
    total = sum(r["count"] for r in sizes)
    assert 2 <= len(sizes) <= 4 and max(r["count"] for r in sizes) < 0.8 * total
    assert max(len(_files(tmp_path / "t" / d)) for d in os.listdir(tmp_path / "t") if "=" in d) <= 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_metrics_of_a_write_are_counted_once(spark, tmp_path):
    df = spark.range(5_000).repartition(12).withColumn("k", F.col("id") % 7)
    want = {"n": 5_000, "odd": 2_500}
    metrics = {"n": F.count(F.lit(1)), "odd": F.sum(F.col("id") % 2)}
    for i, how in enumerate(({}, {"sort_by": ["id"]}, {"partition_by": ["k"]},
                             {"partition_by": ["k"], "parts": 2})):
        assert write_table(df, str(tmp_path / f"t{i}"), **how, metrics=metrics) == want
    got = write_table(df.where("id < 0"), str(tmp_path / "none"), ["k"], metrics=metrics)
    assert not got or got["n"] == 0
    assert write_table(df, str(tmp_path / "plain")) == {}


def test_versions_publish_together_and_vacuum(spark, tmp_path):
    from skylane.sources.published import Versions, read_published
    root = str(tmp_path / "out")
    for n in range(3):
        store = Versions(spark, root)
        store.begin()
        write_table(spark.range(n + 1), store.staged("t"))
        if n:  # a version begun but not published is never seen
            assert read_published(spark, root, "t").count() == n
        store.publish(["t"])
    late = Versions(spark, root)
    late.begin()
    write_table(spark.range(99), late.staged("t"))
    assert read_published(spark, root, "t").count() == 3
    assert len(late.vacuum(keep=1)) == 2
    assert late.version in late.all() and len(late.published()) == 1  # a run under way stays
    assert read_published(spark, root, "t").count() == 3


def test_reading_before_the_first_version(spark, tmp_path):
    import pytest
    from skylane.sources.published import read_published
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "nothing"), "t")
