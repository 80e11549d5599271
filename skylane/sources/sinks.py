"""Sinks: partitioned Parquet tables (full rebuild) and a JDBC export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", sort_by: list[str] | None = None,
                max_records_per_file: int = 5_000_000, parts: int | None = None,
                metrics: Mapping[str, Column] | None = None) -> dict[str, object]:
    """Write a layer as Parquet; ``overwrite`` rebuilds it like a full refresh.

    ``sort_by`` orders the table globally (range-partitioned sort, files in
    order) — the place for a final ORDER BY.  With ``partition_by`` the rows are
    rebalanced by those columns first, so a partition directory gets a few full
    files and not one from every task; adaptive execution splits a partition
    that is too large for one task.  With ``parts`` each partition value is
    dealt by a hash of the whole row into that many tasks instead, whatever the
    adaptive settings, and so into at most that many files below the row limit
    (equal rows stay together).  Files hold at most ``max_records_per_file`` rows.

    ``metrics`` (name -> aggregate without DISTINCT) are computed by the tasks
    that write and returned.  They stand above the sort or shuffle, in the
    stage that Spark counts once per task, so a repeated task adds nothing.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    elif partition_by and parts:
        df = df.repartition(*partition_by, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                                                  F.lit(parts)))
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    observed = Observation() if metrics else None
    if observed:
        df = df.observe(observed, *[m.alias(name) for name, m in metrics.items()])
    w = df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return observed.get if observed else {}


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                max_connections: int = 8, batch_size: int = 10_000) -> None:
    """Replace ``table`` in a relational database with ``df``.

    The table is dropped and recreated (``truncate=false``), the executors write
    in parallel through at most ``max_connections`` connections.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("truncate", "false")
    props.setdefault("numPartitions", str(max_connections))
    df.write.jdbc(url=url, table=table, mode="overwrite", properties=props)
