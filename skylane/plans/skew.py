"""Joins that keep their tasks even when one key holds a large share of the rows.

A shuffle join sends all rows of a key to one task.  Here a sketch of the larger
side names its heavy keys, only these are dealt into parts, and the other side's
rows of a heavy key are repeated once per part.  Every row of the larger side
has one part, so the result is that of the plain join, whatever the sketch says;
nothing hangs on the caller's adaptive-execution settings.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skylane.plans.strategy import fits

#: A key is heavy from this share of an even task's rows.
HEAVY = 0.5
#: Rows of a key that any task takes with ease.
LIGHT_ROWS = 10_000
#: Parts of a heavy key per even task that its rows would fill: many small
#: parts fall evenly on the tasks.
PARTS = 16


def heavy_keys(df: DataFrame, keys: Sequence[str], tasks: int) -> dict[int, list[int]]:
    """The hashes of the keys with more than ``HEAVY / tasks`` of the rows (and
    more than ``LIGHT_ROWS``), by their numbers of parts (powers of two).  They are at most ``tasks / HEAVY``,
    from one frequent-items sketch, whose partial sketches are of bounded size."""
    most = int(tasks / HEAVY)
    row = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {most}, {min(1_000_000, 16 * most)})").alias("top"),
        F.count(F.lit(1)).alias("n")).first()  # one row
    even = row["n"] / tasks
    found: dict[int, list[int]] = {}
    for top in row["top"] if row["n"] else []:
        if top["count"] > max(HEAVY * even, LIGHT_ROWS):
            found.setdefault(1 << math.ceil(math.log2(PARTS * top["count"] / even)), []).append(top["item"])
    return found


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` (``inner``, ``left``, ``left_semi`` or
    ``left_anti``) with the heavy keys of ``left`` dealt into parts.

    A row's part is a hash of the row, so a task that is run again deals it
    alike; equal rows share a part.  NULL keys match nothing, heavy or not.
    ``left`` is read once more, its key columns only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how must be inner, left, left_semi or left_anti, not {how!r}")
    keys = list(keys)
    for key in keys:
        kinds = [df.schema[key].dataType.simpleString() for df in (left, right)]
        if kinds[0] != kinds[1]:
            raise ValueError(f"key {key} has different types: {kinds}")
    heavy = heavy_keys(left, keys, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not heavy:
        return left.join(right, keys, how)
    parts = F.lit(1)  # a few branches, each a lookup in a set
    for number, hashes in heavy.items():
        parts = F.when(F.xxhash64(*keys).isin(hashes), number).otherwise(parts)
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.lit(1)), parts)
    dealt = left.withColumn("_part", own.cast("int"))
    repeated = right.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")


def bounded_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                 right_bound: int | None, max_rows: int) -> DataFrame:
    """``left.join(right, keys, how)``: ``right`` is broadcast when its known
    bound (or else its count) is within ``max_rows``; beyond it, the sides meet
    by ``split_join``."""
    if fits(right, right_bound, max_rows):
        return left.join(F.broadcast(right), list(keys), how)
    return split_join(left, right, keys, how)
