import numpy as np
import pytest

from skylane.llm.whitening import packed, unpacked, whiten

SCHEMA = "vec_id long, embedding array<float>, component string, x string, copies int, size int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "c", "x", 1, 2)
                                  for i, v in rows], SCHEMA)


def brute(rows, by_counts=False, components=16):
    """vec_id -> per component (n, deviation, whitened, explained)."""
    kept = [(i, [int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    xs = [list(x) for x in ({tuple(x): 0 for _, x in kept} if not by_counts else [x for _, x in kept])]
    n, total = len(xs), np.array(xs, object).sum(axis=0)
    y = np.array([[float(n * a - s) / n for a, s in zip(x, total)] for x in xs])
    values, columns = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    out = []
    for i, x in kept:
        centred = np.array([float(n * a - s) / n for a, s in zip(x, total)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, total))
        for k, c in enumerate(order):
            out.append((i, k + 1, n, deviation, float(centred @ columns[:, c] / np.sqrt(values[c])), values[c] / values.sum()))
    return out


def vectors(rng, n, d):
    mix = rng.normal(size=(d, d)) * np.linspace(3, 0.3, d)
    return [(int(i), (rng.normal(size=d) @ mix / 10).tolist()) for i in range(n)]


@pytest.mark.parametrize("by_counts,d", [(False, 20), (True, 20), (False, 5)])
def test_against_brute_force(spark, by_counts, d):
    rng = np.random.default_rng(4)
    rows = vectors(rng, 300, d)
    rows += [(1000 + k, rows[k % 3][1]) for k in range(200)] + [(5, rows[5][1]), (None, rows[7][1])]
    broken = [(2000, None), (2001, [None] + rows[0][1][1:]), (2002, [float("nan")] * d), (2003, [float("inf")] * d), (2004, [])]
    got = whiten(table(spark, rows + broken), by_counts=by_counts)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted(brute(rows, by_counts), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9
    for k in range(1, min(16, d) + 1):
        own, other = (np.array([r[4] for r in x if r[1] == k]) for x in (got, want))
        assert min(np.abs(own - other).max(), np.abs(own + other).max()) < 1e-7
        assert all(r[5] == pytest.approx(want[k - 1][5], rel=1e-9) for r in got if r[1] == k)


def test_without_variance(spark):
    """Two vectors vary in one direction only; one alone in none."""
    rows = whiten(table(spark, [(1, [1, 2, 3]), (2, [1, 2, 5]), (2, [1, 2, 5])])).collect()
    assert len(rows) == 9 and {r.n for r in rows} == {2}
    first = [r for r in rows if r.component == 1]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == 1 for r in first)
    assert all(r.whitened is None and r.explained == 0 for r in rows if r.component > 1)
    assert all(r.identity_error < 1e-12 for r in rows)
    alone = whiten(table(spark, [(1, [4, 4])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 0, None, None, None)] * 2


def test_lengths_apart_large_entries_and_empty(spark):
    rows = [(1, [1, 2]), (2, [2, 1]), (3, [1, 2, 3]), (4, [0, 2, 3]), (5, [3e38, 1, 1])]
    got = whiten(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n) for r in got if r.component == 1) == [(1, 2), (2, 2), (3, 3), (4, 3), (5, 3)]
    assert {r.deviation is None for r in got if r.vec_id == 5} == {True}
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, None)])).count() == 0


def test_packing_of_vectors():
    for v in ([0], [32767, -32767], [32768], [1 << 40, -5], list(range(70))):
        grid = np.array(v, np.int64)
        ((size, (rows, back)),) = unpacked([packed(grid)]).items()
        assert size == len(v) and back.tolist() == [v]
    assert packed(np.array([1, 2])) != packed(np.array([1, 2, 0]))
