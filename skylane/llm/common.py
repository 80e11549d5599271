"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylane.plans.strategy import new_table_path

# The word rule of the operators (after lower-casing A-Z).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder (below the session's
    ``spark.checkpoint.dir``) and read it back: the lineage is cut, and a lost
    executor only re-reads files.  ``drop_tables`` and ``release_tables`` remove
    it."""
    path = new_table_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._shared_path = path
    return table


def drop_tables(*tables: DataFrame) -> None:
    """Remove tables of ``shared_table`` whose last reader has been written."""
    spark = tables[0].sparkSession
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table._shared_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffles of plans that nobody holds any
    more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` when a count proves at most ``max_rows`` rows, else
    ``df`` unchanged (Spark then plans a shuffle join)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, hot_rows: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``table``, whose column ``count`` has the number
    of rows of each (unique) key.  Keys with more than a ``hot_rows``-th of all
    rows, so at most that many, are broadcast; the others meet by a shuffle in
    which no key is large.  A NULL key meets nothing."""
    total = table.agg(F.sum(count)).first()[0] or 0  # one row
    hot = F.col(count) > total / hot_rows
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    often = table.where(hot).drop(count)
    marked = rows.join(F.broadcast(often.withColumn("_hot", F.lit(True))), keys, "left")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in often.schema if f.name not in keys]
    unknown = rows.where(~known).select(*rows.columns, *empty)
    few = marked.where("_hot").drop("_hot")
    rest = marked.where(F.col("_hot").isNull() & known).select(*rows.columns).join(table.where(~hot).drop(count), keys, "left")
    columns = rows.columns + [e for e in often.columns if e not in keys]
    return few.select(*columns).unionByName(rest.select(*columns)).unionByName(unknown.select(*columns))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable
    is evaluated once, while a plain alias may be inlined at each use."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL stays NULL.  A pure ASCII text takes ``lower``."""
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def normalised_words(text: Column) -> Column:
    """The words of a text joined by one space ('' for NULL or no words)."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " ")
    return F.trim(plain)


def word_array(text: Column) -> Column:
    """The words of a text as an array ([] for NULL or no words)."""
    return let(normalised_words(text), lambda norm: F.when(
        norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " ")))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), so that
    its functions run where the package is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="skylane-code-")) / "skylane.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def give_back() -> None:
    """Freed memory of this worker goes to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


_kept: dict[str, Any] = {}


def kept(key: str, build: Callable[[], Any]) -> Any:
    """What ``build`` made, kept by this worker until another operator keeps
    something: workers serve one operator after the other, and the earlier one's
    tables would stay beside the later one's.  Freed memory goes to the system."""
    if key not in _kept:
        if _kept:
            _kept.clear()
            gc.collect()
            give_back()
        _kept[key] = build()
    return _kept[key]


def text_pieces(texts: pa.Array, size: int = 1 << 20) -> Iterator[pa.Array]:
    """The texts in turn, about ``size`` bytes at once."""
    sums = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    lo, done = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sums, done + size)))
        yield texts.slice(lo, hi - lo)
        lo, done = hi, int(sums[hi - 1])


def components(links: DataFrame, known: DataFrame | None = None, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(id, component): the smallest id that each end of the links (a, b)
    reaches, with the links behind the components ``known``.

    Hooking and pointer jumping: each root takes its smallest neighbouring root
    as parent, chains of parents are shortened to their ends, and the links are
    carried over to the roots, until none joins two of them.  No node's
    neighbours are ever gathered.
    """
    def at_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """The pairs between the components of their ends, larger first."""
        for side in ("a", "b"):
            named = roots.select(F.col("id").alias(side), F.col("component").alias("root"))
            pairs = pairs.join(named, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    links = links.select("a", "b")
    labels = known
    if labels is not None:
        links = at_roots(links, broadcast_if_small(labels, broadcast_rows))
    else:
        links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        links = shared_table(links.distinct(), "links")
        if links.isEmpty():
            break
        hooks = shared_table(links.groupBy("a").agg(F.min("b").alias("b")), "hooks")
        moved = True
        while moved:  # each step halves the chains of parents
            up = broadcast_if_small(hooks, broadcast_rows).select(F.col("a").alias("b"), F.col("b").alias("over"))
            jumped = shared_table(hooks.join(up, "b", "left").select(
                "a", F.coalesce("over", "b").alias("b"), F.col("over").isNotNull().alias("moved")), "hooks")
            hooks, moved = jumped.select("a", "b"), not jumped.where("moved").isEmpty()
        found = hooks.select(F.col("a").alias("id"), F.col("b").alias("component"))
        roots = broadcast_if_small(found, broadcast_rows)
        if labels is None:
            labels = found
        else:
            over = roots.select(F.col("id").alias("component"), F.col("component").alias("root"))
            labels = shared_table(labels.join(over, "component", "left").select(
                "id", F.coalesce("root", "component").alias("component")).unionByName(found), "labels")
        links = at_roots(links, roots)
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
