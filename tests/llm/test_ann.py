import math

import numpy as np
from pyspark.sql import functions as F

from skylane.llm.ann import PER_ROW, _crowds_dealt, adjacency, nearest_neighbours


def brute(rows, k, asked):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 16
            and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if asked(q):
            near = sorted(((-math.fsum(good[q] * v), i) for i, v in good.items() if i != q))[:k]
            out[q] = [i for _, i in near]
    return out


def run(spark, rows, k=20, step=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS node", "2 AS id", "3 AS score")
    got = {}
    for r in nearest_neighbours(df, "vec_id", "embedding", F.col("id") % step == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(got[r.query_id])
    return got


def test_recall_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    unit = lambda: (lambda v: [float(np.float32(x)) for x in v / np.linalg.norm(v)])(rng.normal(size=16))
    rows = [(i, unit()) for i in range(700)]
    rows += [(1000 + i, rows[40][1]) for i in range(300)]  # a third are one vector
    rows += [(3000, None), (3005, [0.0] * 16), (3010, [None] + [1.0] * 15), (3015, [math.nan] + [1.0] * 15),
             (3020, [math.inf] + [1.0] * 15), (3025, [1.0] * 3), (None, unit()), (45, rows[45][1])]
    got, want = run(spark, rows), brute(rows, 20, lambda q: q % 5 == 0)
    assert set(got) == set(want)
    found = [len(set(got[q]) & set(want[q])) / 20 for q in want]
    assert np.mean(found) >= 0.97
    assert got[40] == want[40] and got[1000] == want[1000] and got[1295] == want[1295]


def test_few_vectors(spark):
    rows = [(i * 5, [float(i + 1), 1.0]) for i in range(4)]
    assert run(spark, rows) == {0: [15, 10, 5], 5: [15, 10, 0], 10: [15, 5, 0], 15: [10, 5, 0]}
    assert run(spark, rows[:1]) == {} and run(spark, []) == {}


def test_recall_in_a_dense_region(spark):
    """Scores of near copies differ by far less than an 8-bit code can tell."""
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    vectors = np.concatenate([centre + .02 * np.linalg.norm(centre) * rng.normal(size=(1500, 16)) / 4,
                              rng.normal(size=(500, 16))])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    got, want = run(spark, rows, step=20), brute(rows, 20, lambda q: q % 20 == 0)
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want if q < 1500]) >= 0.95
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.95


def test_crowded_leaves_are_dealt_by_nearness(spark):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(size=8) + .01 * rng.normal(size=(900, 8)), rng.normal(size=(60, 8))]).astype("<f4")
    dealt = spark.createDataFrame([(t, i // 900, i, bytearray(v.tobytes())) for t in range(2) for i, v in enumerate(vectors)],
                                  "tree int, leaf long, node long, code binary")
    again = _crowds_dealt(dealt, 64, 8, 5).toPandas()
    assert sorted(zip(again.tree, again.node)) == [(t, i) for t in range(2) for i in range(960)]
    sizes = again.groupby(["tree", "leaf"]).size()
    assert sizes.max() <= 160 and set(again[again.node >= 900].leaf) == {1}
    # a part is tighter than the region
    spread = lambda ids: vectors[list(ids)].var(axis=0).sum()
    parts = [spread(g) for _, g in again[again.node < 900].groupby(["tree", "leaf"]).node if len(g) > 20]
    assert np.mean(parts) < .85 * spread(range(900))


def test_rows_of_the_graph_are_short(spark):
    """A row holds a few neighbours, so that a batch of rows stays small; all
    neighbours are there."""
    nodes = spark.createDataFrame([(i, bytes([i] * 8)) for i in range(60)], "node long, code binary")
    links = spark.createDataFrame([(0, v, float(v)) for v in range(1, 25)] + [(v, 0, float(v)) for v in range(30, 60)],
                                  "u long, v long, sim float")
    rows = adjacency(nodes, links).collect()
    assert max(len(r.others) for r in rows) <= PER_ROW
    assert sorted(x for r in rows if r.node == 0 for x in r.others) == [*range(1, 25), *range(36, 60)]
    assert all(c == bytes([o] * 8) for r in rows for o, c in zip(r.others, r.codes))
