import random
import re
from itertools import combinations

import pytest

from skylane.llm import neardup
from skylane.llm.neardup import drop_near_duplicates, near_duplicates
from tests.llm.conftest import documents


def shingles(text, width):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return frozenset() if not w else frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(docs, width, threshold):
    sets = {}
    for i, t in docs:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t, width))
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= threshold * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = find(a), find(b)
            group[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def fixture(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    docs, i = [], 0
    for size in (1, 1, 2, 3, 5, 60):
        base = text(rng.randrange(60, 300))
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(1000)
            docs.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
            i += 7
    common = text(80)
    docs += [(1000 + j, " ".join(common + text(30))) for j in range(40)]  # a passage that many share
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "Two Words"), (2004, "two  words"), (2005, "one"),
             (None, docs[0][1]), (None, None), (7, docs[1][1]), (2006, docs[0][1]), (2006, docs[3][1] + " more"),
             (2007, "É é"), (2008, "é é")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("near", [8, 2])
def test_against_brute_force(spark, monkeypatch, near):
    monkeypatch.setattr(neardup, "NEAR", near)
    monkeypatch.setattr(neardup, "STAR", 5)
    docs = fixture()
    want = brute(docs, 3, 85)
    rows = near_duplicates(documents(spark, docs), 3, 85).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]), r
        assert r.kept == (r.component_id == r.doc_id)
    assert sorted(r.n_shingles for r in rows) == sorted(len(shingles(t, 3)) for _, t in docs)


@pytest.mark.parametrize("partitions", [1, 211, 700])
def test_links_do_not_hang_on_the_partitions(spark, partitions):
    rng = random.Random(5)
    docs = []
    for i in range(20):  # pairs at a similarity of about 0.95, and as many single documents
        w = [f"p{i}x{rng.randrange(10**6)}" for _ in range(200)]
        docs += [(3 * i, " ".join(w)), (3 * i + 1, " ".join(w[:100] + ["other"] + w[101:])),
                 (3 * i + 2, " ".join(f"s{rng.randrange(10**6)}" for _ in range(120)))]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        trees = neardup.forest(neardup.signatures(documents(spark, docs), 3).withColumnRenamed("doc_id", "id")
                               .withColumnRenamed("n_shingles", "n"))
        singles = documents(spark, []).selectExpr("doc_id AS id", "doc_id AS component")
        rows, mixed = neardup.open_regions(trees, singles)
        found = {(r.a, r.b) for r in neardup.region_pairs(rows, mixed, 85).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(3 * i, 3 * i + 1) for i in range(20)} <= found


def test_a_crowd_that_shares_a_passage_meets_by_its_own_shingles(spark):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(100)]
    docs = [(i, " ".join(common + [f"d{i}x{k}" for k in range(30)])) for i in range(300)]
    docs += [(1000 + i, " ".join(common + [f"d{i}x{k}" for k in range(29)] + ["end"])) for i in range(0, 300, 9)]
    rng.shuffle(docs)
    crowd = neardup.signatures(documents(spark, docs), 3).selectExpr("doc_id AS id", "bits_a", "bits_b")
    singles = documents(spark, []).selectExpr("doc_id AS id", "doc_id AS component")
    pairs = {(r.a, r.b) for r in neardup.crowded_pairs(documents(spark, docs), crowd, singles, 3, 85).collect()}
    # each copy meets its text, and the common passage alone brings nobody together
    assert pairs == {(i, 1000 + i) for i in range(0, 300, 9)}


def test_drop_keeps_one_of_each_group(spark):
    docs = documents(spark, [(5, "a b c d e f g"), (3, "A b c  d e f g"), (9, "other text here"), (9, "other text here"),
                             (None, "a b c d e f g"), (11, None)])
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [11, 3, 9, None]


def test_drop_keeps_the_smallest_text_of_an_id(spark):
    docs = documents(spark, [(4, "zz yy xx ww vv uu"), (4, "aa bb cc dd ee ff"), (4, None)])
    assert [(r.doc_id, r.text) for r in drop_near_duplicates(docs).collect()] == [(4, "aa bb cc dd ee ff")]


def test_empty(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert drop_near_duplicates(documents(spark, [])).count() == 0


def test_a_crowd_of_near_copies_hangs_together_by_few_pairs(spark, monkeypatch):
    """The pairs read again grow with the crowd, not with its square; a row that
    stands twice counts once."""
    rng = random.Random(4)
    base, docs = [f"c{i}" for i in range(150)], []
    for i in range(240):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10_000)
        docs += [(i, " ".join(w))] * (2 if i % 10 == 0 else 1)
    tried, confirm = [], neardup.confirmed

    def counted(docs, pairs, *args):
        tried.append(pairs.count())
        return confirm(docs, pairs, *args)
    monkeypatch.setattr(neardup, "confirmed", counted)
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, docs), 3, 85).collect()}
    assert got == brute(docs, 3, 85)
    assert sum(tried) < 12 * 240, tried
