import random

import pytest

from skylane.llm import jaccard_join
from skylane.llm.jaccard_join import Threshold, jaccard_components
from tests.llm.conftest import documents
from tests.llm.test_neardup import brute, fixture, shingles


def short_texts(seed=5):
    """Texts of few words that differ by a word or two, and crowds of them."""
    rng = random.Random(seed)
    docs, i = [], 5000
    for size in range(8, 34):
        base = [f"s{rng.randrange(500)}" for _ in range(size + 2)]
        for _ in range(rng.randrange(2, 7)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                where = rng.choice([0, len(w) - 1])  # an end changes one shingle
                w[where:where + 1] = rng.choice([[], ["x%d" % rng.randrange(9)], [w[where], "y%d" % rng.randrange(9)]])
            docs.append((i, " ".join(w)))
            i += 3
    return docs


def crowd(seed=8):
    """Copies of one text, linked with each other or only through a few."""
    rng = random.Random(seed)
    base = [f"c{rng.randrange(10_000)}" for _ in range(150)]
    docs = []
    for k in range(80):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10_000)
        docs.append((9000 + k, " ".join(w)))
    return docs


@pytest.mark.parametrize("light,width,hundredths,boundary", [(16, 3, 90, None), (2, 5, 80, None), (3, 3, 85, 25)])
def test_against_brute_force(spark, monkeypatch, light, width, hundredths, boundary):
    monkeypatch.setattr(jaccard_join, "LIGHT", light)
    if boundary:
        monkeypatch.setattr(jaccard_join, "boundary_of", lambda *a: boundary)
    docs = fixture() + short_texts() + crowd()
    want = brute(docs, width, hundredths)
    rows = jaccard_components(documents(spark, docs), width, hundredths).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]), r
    assert sorted(r.n_shingles for r in rows) == sorted(len(shingles(t, width)) for _, t in docs)


def test_many_partitions_without_adaptive_plans(spark):
    docs = crowd(1) + short_texts(2)
    want = brute(docs, 3, 90)
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "67"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.component_id for r in jaccard_components(documents(spark, docs), 3, 90).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want


def test_bounds_of_sizes():
    """Two linked sets meet in the lists that the bounds promise."""
    rng = random.Random(3)
    for t in (70, 80, 90):
        bounds = Threshold(t)
        for _ in range(2000):
            n, m = rng.randrange(1, 60), rng.randrange(1, 60)
            both = rng.randrange(0, min(n, m) + 1)
            linked = 100 * both >= t * (n + m - both)
            assert linked == (both >= bounds.overlap(n, m))
            if linked:
                assert m in bounds.partners(n) and n in bounds.partners(m)
                items = rng.sample(range(1000), n + m - both)
                x, y = sorted(items[:n]), sorted(items[n - both:])
                met = set(x[:bounds.posted(n)]) & set(y[:bounds.posted(m)])
                assert len(met) >= bounds.met(min(n, m)) >= bounds.met(bounds.least(max(n, m)))


def test_empty(spark):
    assert jaccard_components(documents(spark, [])).count() == 0
    rows = jaccard_components(documents(spark, [(1, None), (None, "a b"), (2, "")])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == [(1, 0, 1), (2, 0, 2), (None, 1, None)]


def test_texts_are_read_in_small_pieces():
    """A task hashes about a megabyte of texts at once, whatever the batch."""
    import pyarrow as pa
    from skylane.llm.jaccard_join import text_pieces
    texts = pa.array([None, "x" * 3_000_000, ""] + ["word " * 700] * 1000)
    found = list(text_pieces(texts))
    assert [t for piece in found for t in piece.to_pylist()] == texts.to_pylist()
    assert all(len(piece) == 1 or sum(len(t or "") for t in piece.to_pylist()) <= 1 << 20 for piece in found[1:])


def test_items_of_one_set_alone_make_no_subsets(spark, monkeypatch):
    """Short texts without common shingles are listed under no subset."""
    docs = [(i, " ".join(f"w{i}x{k}" for k in range(24))) for i in range(60)]
    docs += [(100, " ".join(["a"] + [f"v{k}" for k in range(24)])), (101, " ".join([f"v{k}" for k in range(24)] + ["b"]))]
    made, write = {}, jaccard_join.shared_table

    def counted(df, name):
        table = write(df, name)
        made[name] = table.count()
        return table
    monkeypatch.setattr(jaccard_join, "shared_table", counted)
    monkeypatch.setattr(jaccard_join, "boundary_of", lambda *a: 40)
    got = {r.doc_id: r.component_id for r in jaccard_components(documents(spark, docs), 3, 90).collect()}
    assert got == brute(docs, 3, 90) and got[101] == 100
    assert 0 < made["subsets"] < 100
