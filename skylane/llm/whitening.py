"""Embedding whitening from a covariance of distinct vectors.

A vector's entries are put on a grid (``floor(scale * c)`` plus an offset,
whole numbers); equal vectors of the grid are one row of the fit list, which carries
how often it occurs.  The fit weights are one per distinct vector, or those
counts.  The weighted covariance comes from one product of matrices per batch of
vectors that were centred first; its eigenvectors whiten each distinct vector
once, and the result is joined back to the rows.

Sums of the grid are whole numbers and exact.  A vector is centred as
``(n * x - S) / n``, from the exact difference.  Partial covariances are summed
by cell, so a task's part is one row per cell whatever the number of vectors.
The covariance (dimension squared) and the components come to the driver.

Defined results: rows whose vector is NULL, empty or holds NULL or non-finite
entries are left out; vectors of different length are fitted apart, each length
by itself (``n`` is then that length's); repeated rows and repeated or NULL ids
each get their rows; ties between eigenvalues take any basis of their space; a
component without variance (an eigenvalue below 1e-12 of the largest, as with
fewer vectors than dimensions) has ``whitened`` NULL and does not count in
``identity_error``, which is NULL if no component varies; ``explained`` is NULL
if nothing varies; a deviation beyond 64 bits is NULL; entries beyond 2**62 of
the grid stand at that bound; an empty table gives no rows.  Only the id and
the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylane.llm.common import join_counted, shared_table

#: The offset of the grid (1,000,000 in the query's contract) cancels out of
#: every difference, so vectors are kept without it.
SCALE = 64
COMPONENTS = 16
#: Eigenvalues below this part of the largest are no variance.
NO_VARIANCE = 1e-12
_WIDTHS = (2, 4, 8)


def packed(grid: np.ndarray) -> bytes:
    """A vector of the grid, without the offset: one byte of width, then whole
    numbers of the least width.  Equal vectors have equal bytes."""
    for width in _WIDTHS:
        if width == 8 or np.abs(grid).max(initial=0) < 1 << (8 * width - 1):
            return bytes([width]) + grid.astype(f"<i{width}").tobytes()
    raise AssertionError


def unpacked(vectors: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: the rows' places and their vectors as a matrix."""
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, v in enumerate(vectors):
        kinds.setdefault((v[0], (len(v) - 1) // v[0]), []).append(i)
    out: dict[int, list[tuple[list[int], np.ndarray]]] = {}
    for (width, size), rows in kinds.items():
        flat = np.frombuffer(b"".join(vectors[i][1:] for i in rows), f"<i{width}")
        out.setdefault(size, []).append((rows, flat.reshape(len(rows), size).astype(np.int64)))
    return {size: (np.concatenate([np.array(r) for r, _ in parts]), np.concatenate([m for _, m in parts])) for size, parts in out.items()}


def on_grid(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x) of the rows that take part; x is packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["vector"]
            ids, xs = [], []
            lengths = np.diff(np.asarray(column.offsets))
            flat = column.flatten()
            nulls = np.asarray(flat.is_null(nan_is_null=True))
            values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            valid = np.asarray(column.is_valid())
            at = 0
            for i, n in enumerate(lengths):
                if not valid[i]:
                    continue
                own = values[at:at + n]
                if n and not nulls[at:at + n].any() and np.isfinite(own).all():
                    ids.append(i)
                    xs.append(packed(np.clip(np.floor(own * scale), -2.0 ** 62, 2.0 ** 62).astype(np.int64)))
                at += n
            yield pa.record_batch([batch["id"].take(pa.array(ids, pa.int64())), pa.array(xs, pa.binary())], ["id", "x"])
    kept = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return kept.mapInArrow(run, "id long, x binary")


def sums(vectors: DataFrame, by_counts: bool) -> dict[int, tuple[int, np.ndarray]]:
    """Per length: the number of vectors and the exact sums of their entries
    (without the offset)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            counts = batch["copies"].to_numpy() if by_counts else np.ones(batch.num_rows, np.int64)
            for size, (rows, grid) in unpacked(batch["x"].to_pylist()).items():
                n, own = total.get(size, (0, [0] * size))
                if np.abs(grid).max(initial=0) < 1 << 31 and counts.max(initial=0) < 1 << 20:
                    parts = (grid * counts[rows][:, None]).sum(axis=0)
                else:
                    parts = (grid.astype(object) * counts[rows].astype(object)[:, None]).sum(axis=0)
                total[size] = (n + int(counts[rows].sum()), [a + int(b) for a, b in zip(own, parts)])
        rows = [(size, n, i, str(v)) for size, (n, own) in total.items() for i, v in enumerate(own)]
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.string()))],
                              ["size", "n", "i", "v"])
    found = vectors.select("x", "copies").mapInArrow(run, "size int, n long, i int, v string") \
        .groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # dimensions
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in found:
        out.setdefault(r["size"], (r["n"], np.zeros(r["size"], object)))[1][r["i"]] = int(r["v"])
    return out


def centred(grid: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray | list]:
    """(n * x - S) / n, and the sums over dimensions of (n * x - S) ** 2."""
    if n < 1 << 31 and np.abs(grid).max(initial=0) < 1 << 31 and max(abs(int(v)) for v in total) < 1 << 62:
        difference = grid * n - total.astype(np.int64)
        largest = int(np.abs(difference).max(initial=0))
        if largest ** 2 * max(1, grid.shape[1]) < 1 << 63:
            return difference / n, (difference ** 2).sum(axis=1)
        exact = difference.astype(object)
    else:
        exact = grid.astype(object) * n - total
        difference = exact.astype(np.float64)
    squares = (exact ** 2).sum(axis=1)
    return difference / n, [int(s) if s < 1 << 63 else None for s in squares]


def products(batch_of, df: DataFrame, schema: str = "size int, i int, j int, v double") -> dict[int, np.ndarray]:
    """Per length: the sum of the matrices that ``batch_of`` makes of batches,
    added up by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, matrix in batch_of(batch):
                total[size] = total[size] + matrix if size in total else matrix
        for size, matrix in total.items():
            i, j = np.triu_indices(len(matrix))
            yield pa.record_batch([pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                   pa.array(matrix[i, j])], ["size", "i", "j", "v"])
    out: dict[int, np.ndarray] = {}
    found = df.mapInArrow(run, schema).groupBy("size", "i", "j").agg(F.sum("v").alias("v")).collect()  # dimensions squared
    width: dict[int, int] = {}
    for r in found:
        width[r["size"]] = max(width.get(r["size"], 0), r["j"] + 1)
    for r in found:
        matrix = out.setdefault(r["size"], np.zeros((width[r["size"]],) * 2))
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["v"]
    return out


@dataclass(frozen=True)
class Fit:
    """Of the vectors of one length: their number and sums, and per component
    the column that whitens (NaN without variance) and its share of variance."""

    n: int
    total: np.ndarray
    whitener: np.ndarray
    explained: list[float | None]


def fit(vectors: DataFrame, components: int, by_counts: bool) -> dict[int, Fit]:
    """The fit of each length among ``vectors`` (x, copies)."""
    known = sums(vectors, by_counts)
    shared = vectors.sparkSession.sparkContext.broadcast(known)  # dimensions

    def gram(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        counts = batch["copies"].to_numpy() if by_counts else np.ones(batch.num_rows)
        for size, (rows, grid) in unpacked(batch["x"].to_pylist()).items():
            y, _ = centred(grid, *shared.value[size])
            yield size, (y * counts[rows][:, None]).T @ y
    out = {}
    for size, matrix in products(gram, vectors.select("x", "copies")).items():
        n, total = known[size]
        values, columns = np.linalg.eigh(matrix / n)
        first = np.argsort(-values, kind="stable")[:components]
        trace = np.trace(matrix / n)
        largest = max(values.max(), 0)
        whitener = columns[:, first]
        whitener = whitener * np.sign(whitener[np.abs(whitener).argmax(axis=0), np.arange(len(first))])
        varies = (values[first] > NO_VARIANCE * largest) & (largest > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            whitener = np.where(varies, whitener / np.sqrt(np.where(varies, values[first], 1)), np.nan)
        out[size] = Fit(n, total, whitener, [float(max(v, 0) / trace) if trace > 0 else None for v in values[first]])
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, by_counts: bool = False) -> DataFrame:
    """Per row that takes part and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error.  The fit list is each
    distinct vector once, or as often as it occurs if ``by_counts``."""
    points = shared_table(on_grid(rows, id_col, vector_col, scale), "grid")
    vectors = shared_table(points.groupBy("x").agg(F.count("*").alias("copies")), "distinct-vectors")
    fits = fit(vectors, components, by_counts)
    shared = rows.sparkSession.sparkContext.broadcast(fits)  # dimension times components, per length

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviations, whitened, lengths = ([None] * batch.num_rows for _ in range(3))
            for size, (places, grid) in unpacked(batch["x"].to_pylist()).items():
                own = shared.value[size]
                y, squares = centred(grid, own.n, own.total)
                for i, s, z in zip(places.tolist(), squares, (y @ own.whitener).tolist()):
                    deviations[i], whitened[i], lengths[i] = s if s is None else int(s), z, size
            yield pa.record_batch([
                batch["x"], batch["copies"], pa.array(lengths, pa.int32()), pa.array(deviations, pa.int64()),
                pa.array(whitened, pa.list_(pa.float64()))], ["x", "copies", "size", "deviation", "whitened"])
    done = shared_table(vectors.mapInArrow(apply, "x binary, copies long, size int, deviation long, whitened array<double>"), "whitened")

    def moments(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        counts = batch["copies"].to_numpy() if by_counts else np.ones(batch.num_rows)
        sizes = batch["size"].to_numpy()
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            z = np.array([batch["whitened"][int(i)].as_py() for i in own])
            z = np.column_stack([np.ones(len(z)), z])  # the first row of the product has the sums
            yield size, (z * counts[own][:, None]).T @ z
    errors = {}
    for size, matrix in products(moments, done).items():
        mean = matrix[0, 1:] / matrix[0, 0]
        off = matrix[1:, 1:] / matrix[0, 0] - np.outer(mean, mean) - np.eye(len(mean))
        off = np.abs(off[~np.isnan(off)])
        errors[size] = float(off.max()) if len(off) else None
    kinds = rows.sparkSession.createDataFrame(
        [(size, k + 1, f.n, e, errors[size]) for size, f in fits.items() for k, e in enumerate(f.explained)],
        "size int, component int, n long, explained double, identity_error double")
    each = join_counted(points, done, ["x"], "copies").select(
        F.col("id").alias("vec_id"), "size", "deviation", F.posexplode("whitened").alias("place", "value"))
    return each.withColumn("component", F.col("place") + 1).join(F.broadcast(kinds), ["size", "component"]).select(
        "vec_id", "component", "n", "deviation", F.when(~F.isnan("value"), F.col("value")).alias("whitened"), "explained", "identity_error")


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings, whitened by the covariance of the distinct ones."""
    from skylane.llm.common import read_table
    return whiten(read_table(spark, sf_dir, "embeddings"))
