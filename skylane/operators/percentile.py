"""Exact percentile with linear interpolation (``percentile_cont``) per group.

Two plans give the same numbers:

* ``hash``: Spark's exact ``percentile`` aggregate.  It merges every distinct
  value of a group in one task, so it is used only when the largest group is
  proven to hold at most ``max_group_rows`` rows.
* ``range``: values are range-partitioned by (group, value) — Spark samples
  the split points, so a group holding a third of all rows is spread over many
  tasks — and sorted inside each partition.  A row's rank in its group is the
  number of the group's rows in earlier partitions (a small per-(group,
  partition) table) plus its position in its own partition.  Only the two rows
  at the interpolation ranks of each group are kept.  The ranked rows are
  written once and read by both uses: partition and position numbers are only
  comparable within one execution of the sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from skylane.plans.strategy import broadcast_within, materialize


def exact_percentile(df: DataFrame, groups: Sequence[str], value: str, p: float, out: str,
                     group_bound: int | None, max_group_rows: int,
                     broadcast_max_rows: int, method: str | None = None) -> DataFrame:
    """One row per group of ``df`` with ``out`` = percentile_cont(p) of ``value``
    (NULLs ignored; NULL when the group has no value).

    ``group_bound``: proven upper bound of any group's rows (None = unknown).
    ``method``: force ``"hash"`` or ``"range"``; by default ``hash`` only when
    ``group_bound <= max_group_rows``.
    """
    groups = list(groups)
    if method is None:
        method = "hash" if group_bound is not None and group_bound <= max_group_rows else "range"
    if method == "hash":
        return df.groupBy(*groups).agg(F.percentile(value, p).alias(out))
    if method != "range":
        raise ValueError(f"method must be 'hash' or 'range', not {method!r}")

    # joins below use one non-NULL struct key, so a NULL group value (a real
    # group of GROUP BY) still matches itself
    g = F.struct(*groups).alias("_g")
    counts = df.groupBy(g).agg(F.count(value).alias("_n"))
    vals = df.select(g, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ranked = (vals.repartitionByRange("_g", "_v")
              .sortWithinPartitions("_g", "_v")
              .select("*", F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    ranked = materialize(ranked, name="ranked-values")
    # rows of each group in each partition; a group spans a run of partitions,
    # so this has at most #groups + #partitions rows
    blocks = ranked.groupBy("_g", "_pid").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_g", "_pid", "_first",
                           F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # range exchange width
    blocks = broadcast_within(blocks, None if group_bound is None else group_bound + n_parts,
                              broadcast_max_rows)
    pos = counts.where(F.col("_n") > 0).select(
        "_g", (F.lit(float(p)) * (F.col("_n") - 1)).alias("_h"))
    pos = broadcast_within(pos, group_bound, broadcast_max_rows)
    rank = F.col("_off") + F.col("_mid") - F.col("_first")
    lo, hi = F.floor("_h"), F.ceil("_h")
    picked = (ranked.join(blocks, ["_g", "_pid"]).join(pos, "_g")
              .where((rank == lo) | (rank == hi))
              .groupBy("_g", "_h")
              .agg(F.max(F.when(rank == lo, F.col("_v"))).alias("_lo"),
                   F.max(F.when(rank == hi, F.col("_v"))).alias("_hi")))
    # same interpolation as Spark's percentile: (hi_rank - h) * lo + (h - lo_rank) * hi
    interp = F.when(lo == hi, F.col("_lo")).otherwise(
        (hi - F.col("_h")) * F.col("_lo") + (F.col("_h") - lo) * F.col("_hi"))
    result = picked.select("_g", interp.alias(out))
    return counts.join(result, "_g", "left").select(*[F.col(f"_g.{c}").alias(c) for c in groups], out)
