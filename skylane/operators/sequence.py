"""Ordered-sequence steps (previous row, running total, row number, next row)
that scale past one task per sequence.

A plain ``lag`` or running ``sum`` over ``partitionBy(keys)`` puts each whole
sequence into one task — and with no keys, the whole table.  Here the
sequence is cut into segments (a time bin of the ordering column): the window
runs per (keys, segment), and a small table of one row per segment (last row,
totals, first value) carries the state across segment boundaries.  The window
over that table is the only step that sees a whole sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SEG = "_seg"


def lag_in_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    segment: Column, cols: Sequence[str], prefix: str = "prev_",
                    count_col: str | None = None, weight: str | None = None,
                    mode: str = "table") -> DataFrame:
    """Add ``prefix + c`` = previous row's ``c`` in (keys, ascending ``order``).

    ``count_col``: also add the number of rows of the row's keys, or the sum of
    the column ``weight`` over them (from the boundary rows, no extra pass).

    ``keys`` must be non-NULL; ``order`` must be ascending and total within
    ``keys``; ``segment`` must be non-NULL and non-decreasing along ``order``.

    The rows are exchanged once, by (keys, segment), and looked back within
    their segment.  What crosses a segment's end is one boundary row per
    segment: its last row and its total.  They are read from the written rows
    (``mode`` as in ``materialize``), carried to the next segment of the keys
    and joined to the rows on the partitioning that these have; a broadcast or
    an exchange moves the boundary rows only.
    """
    from skylane.plans.strategy import materialize

    w = Window.partitionBy(*keys, SEG).orderBy(*[F.col(o).asc() for o in order])
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.lead(F.lit(True)).over(w).isNull()
    total = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    local = materialize(df.withColumn(SEG, segment).select(
        "*",
        F.row_number().over(w).alias("_pos"),
        *[F.lag(c).over(w).alias(f"_lag{i}") for i, c in enumerate(cols)],
        F.when(last, total.over(whole)).alias("_total"),
    ), mode, "sequence")
    boundary = local.where(F.col("_total").isNotNull()).select(
        *keys, SEG, F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)]).alias("_last"), "_total")
    ws = Window.partitionBy(*keys).orderBy(SEG)
    extra = ([F.sum("_total").over(Window.partitionBy(*keys)).alias(count_col)]
             if count_col else [])
    carry = boundary.select(*keys, SEG, F.lag("_last").over(ws).alias("_carry"), *extra)
    out = local.drop("_total").join(carry, [*keys, SEG], "left")
    for i, c in enumerate(cols):
        out = out.withColumn(
            prefix + c,
            F.when(F.col("_pos") == 1, F.col(f"_carry.v{i}")).otherwise(F.col(f"_lag{i}")))
    return out.drop("_pos", "_carry", *[f"_lag{i}" for i in range(len(cols))])


def sweep(df: DataFrame, keys: Sequence[str], order: str, segment: Column,
          value: str, max_summary_rows: int, summary_bound: int | None = None) -> DataFrame:
    """Running total, row number and next value along ``order`` per ``keys``.

    ``df`` holds one row per distinct non-NULL ``order`` value within
    (non-NULL) ``keys``.  Adds
    ``running`` (sum of ``value`` up to and including the row), ``row_num``
    (1-based position) and ``next_value`` (the next row's ``order``, NULL on
    the last row).  Per-segment offsets come from a summary with one row per
    (keys, segment), broadcast when its bound (or count) is below
    ``max_summary_rows``.
    """
    from skylane.plans.strategy import broadcast_within

    d = df.withColumn(SEG, segment)
    summary = d.groupBy(*keys, SEG).agg(
        F.sum(value).alias("_tot"), F.count(F.lit(1)).alias("_rows"),
        F.min(order).alias("_first"))
    ws = Window.partitionBy(*keys).orderBy(SEG)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *keys, SEG,
        F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off_tot"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off_rows"),
        F.lead("_first").over(ws).alias("_next_first"),
    )
    summary = broadcast_within(summary, summary_bound, max_summary_rows)
    j = d.join(summary, [*keys, SEG], "inner")
    w = Window.partitionBy(*keys, SEG).orderBy(F.col(order).asc())
    return j.select(
        *[c for c in d.columns if c != SEG],
        (F.col("_off_tot") + F.sum(value).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("running"),
        (F.col("_off_rows") + F.row_number().over(w)).alias("row_num"),
        F.coalesce(F.lead(order).over(w), F.col("_next_first")).alias("next_value"),
    )
