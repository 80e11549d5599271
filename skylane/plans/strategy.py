"""Join-strategy and lineage helpers.

Broadcasts happen only behind a proven row bound:

* ``sized_broadcast`` counts a side (at most ``max_rows + 1`` rows, ``limit``
  stops early) and broadcasts it only below the bound;
* ``FlightBounds`` is measured once with one aggregate over the filtered
  flights.  Every flight-level table (qualifying keys, fuel per flight,
  occupancy instants, percentile groups, moving averages) has at most that many
  rows, so those broadcast decisions need no further job.

Above a bound the DataFrame is returned unchanged and Spark plans a shuffle
join (AQE may still switch to a broadcast from runtime sizes, and splits skewed
partitions); the joins of the largest tables go through ``skew.bounded_join``,
which splits heavy keys itself.  ``materialize`` cuts lineage with a reliable checkpoint in the
folder the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DayTimeIntervalType

from skylane.functions.timefns import bin_seconds, seconds_between


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` if df has at most ``max_rows`` rows, else ``df``."""
    return broadcast_within(df, None, max_rows)


def fits(df: DataFrame, upper_bound: int | None, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows: by a known upper bound, or
    counted when there is none."""
    return (df.limit(max_rows + 1).count() if upper_bound is None else upper_bound) <= max_rows


def broadcast_within(df: DataFrame, upper_bound: int | None, max_rows: int) -> DataFrame:
    """Broadcast ``df`` when a known upper bound of its rows is within
    ``max_rows``; count it when no bound is known."""
    return F.broadcast(df) if fits(df, upper_bound, max_rows) else df


@dataclass(frozen=True)
class FlightBounds:
    """Upper bounds measured on the filtered flights.

    flights: number of flight rows (bounds every per-flight table).
    span_seconds: from the earliest entry/landing to the latest one.
    first_time, last_time: that earliest and latest instant (None if no flight);
      every terminal-area window lies inside them.
    """

    flights: int
    span_seconds: float
    first_time: object = None
    last_time: object = None

    def bins(self, unit: str) -> int:
        """Upper bound of the time bins of ``unit`` touched inside the span."""
        return int(self.span_seconds // bin_seconds(unit)) + 2

    @staticmethod
    def measure(filtered: DataFrame) -> "FlightBounds":
        t = filtered.select(F.least("entry_time", "landing_time").alias("lo"),
                            F.greatest("entry_time", "landing_time").alias("hi"))
        row = t.agg(F.count(F.lit(1)).alias("n"),
                    seconds_between(F.min("lo"), F.max("hi")).alias("span"),
                    F.min("lo").alias("first"), F.max("hi").alias("last")).collect()[0]
        return FlightBounds(flights=int(row["n"]), span_seconds=float(row["span"] or 0.0),
                            first_time=row["first"], last_time=row["last"])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting it from the config.

    On a cluster the shared folder comes from ``spark.checkpoint.dir``.  Only a
    local session (tests) without that setting gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="skylane-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder to materialise layers")
    return sc.getCheckpointDir()


_written: dict[str, list[str]] = {}


def new_table_path(spark: SparkSession, name: str) -> str:
    """Path of a new intermediate table in the shared checkpoint folder;
    ``release_tables`` removes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skylane-tables/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has written so far
    and return how many there were.  Results that still read them (lazy
    DataFrames) must have been written before."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def materialize(df: DataFrame, mode: str = "table", name: str = "layer") -> DataFrame:
    """Compute ``df`` once for several consumers.

    ``table``: write it as Parquet under the shared checkpoint folder and read
    it back — lineage cut, columnar and compressed, and each consumer reads
    only the columns it needs (layers with interval columns, which Parquet
    cannot store, use ``checkpoint``).  ``checkpoint``: Spark's reliable
    checkpoint into the same folder.  Either way a lost executor re-reads
    files instead of recomputing the upstream joins.  ``cache``: keep it in
    executor memory/disk (``MEMORY_AND_DISK``) for one session; lost blocks are
    recomputed from lineage.  ``none``: return ``df`` unchanged.
    """
    if mode == "table":
        if any(isinstance(f.dataType, DayTimeIntervalType) for f in df.schema.fields):
            return materialize(df, "checkpoint")
        from skylane.sources.sinks import write_table
        path = new_table_path(df.sparkSession, name)
        write_table(df, path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "none":
        return df
    raise ValueError(f"materialize mode must be table, checkpoint, cache or none, not {mode!r}")
