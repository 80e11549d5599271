import hashlib
import random
import re

from pyspark.sql import functions as F

from skylane.llm.decontamination import contamination, decontaminate, is_contaminated
from tests.llm.conftest import documents


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(len(w), 13)
        if item is None or not k:
            continue
        for s in range(len(w) - k + 1):
            windows.setdefault(tuple(w[s:s + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit |= set(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "gamma", "DELTA", "été", "z9", "eta", "theta"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([14, 20, 30]))) for i in range(6)] + [
        (6, "solo"), (7, "two Words"), (8, "one two three four"), (9, ""), (10, None), (None, "never used id"),
        (11, "Two words"), (6, "one two three four five six seven")]
    docs = []
    for i in range(40):
        parts = [text(rng.randrange(0, 40))]
        if rng.random() < .7:
            item = rng.choice([t for _, t in items if t])
            cut = item.split()[rng.randrange(0, 3):]
            parts += [" ".join(cut), text(rng.randrange(0, 10))]
        if rng.random() < .3:
            parts.append(rng.choice(["SOLO!", "two--words", "one two three four"]))
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "!!! ... "), (None, "so solo it is"), (None, None), (3, docs[3][1]),
             (5, "another text of one id: two words"), (103, "w" * 30000), (104, "solo " * 5000)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = fixture()
    found = contamination(documents(spark, docs), documents(spark, items, "item_id long, text string"))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in found.collect()), key=str)
    assert got == brute(docs, items)
    assert all(r.n_hit == sum(s.stop - s.start for s in r.spans) for r in found.collect())


def test_shuffle_joins_give_the_same(spark):
    docs, items = fixture()
    found = contamination(documents(spark, docs), documents(spark, items, "item_id long, text string"), broadcast_rows=0)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in found.collect()), key=str)
    assert got == brute(docs, items)


def test_modes(spark):
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(13)))], "item_id long, text string")
    passage = " ".join(f"W{i}" for i in range(13))
    docs = documents(spark, [(1, f"Before, {passage}; after."), (2, "clean words"), (3, None),
                             (4, passage + " and" * 400), (None, passage)])
    left = decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == [2, 3, 4]
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, mode="spans").collect()}
    assert len(cut) == 5 and cut[2] == "clean words" and cut[3] is None
    assert words(cut[1]) == ["before", "after"] and cut[1].startswith("Before, ") and cut[1].endswith("; after.")
    assert words(cut[4]) == ["and"] * 400


def test_many_separate_hits_in_one_text(spark):
    docs = documents(spark, [(1, "solo x " * 50_000), (2, "x two words " * 20_000)])
    items = spark.createDataFrame([(6, "solo"), (7, "two words"), (8, "a b c d e f g h i j k l m n")],
                                  "item_id long, text string")
    got = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert (got[1].n_words, got[1].n_hit, len(got[1].spans), got[1]["items"]) == (100_000, 50_000, 50_000, [6])
    assert (got[2].n_words, got[2].n_hit, len(got[2].spans), got[2]["items"]) == (60_000, 40_000, 20_000, [7])
    cut = {r.doc_id: r.text for r in decontaminate(docs, items, mode="spans").collect()}
    assert cut[1] == " x " * 50_000 and cut[2] == "x   " * 20_000


def test_spans_cut_words_only(spark):
    items = spark.createDataFrame([(1, "solo"), (2, "two words")], "item_id long, text string")
    texts = ["solo", "-solo-", "a, solo; b two--words! c", "two words solo", "(two words) x (solo)", "x"]
    cut = {r.doc_id: r.text for r in decontaminate(documents(spark, list(enumerate(texts))), items, mode="spans").collect()}
    assert [cut[i] for i in range(6)] == ["", "--", "a, ; b --! c", "  ", "( ) x ()", "x"]


def test_empty_tables(spark):
    docs, bench = documents(spark, [], ), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(docs, bench).count() == 0
    some = documents(spark, [(1, "a b c")])
    assert [(r.n_words, r.n_hit) for r in contamination(some, bench.limit(0)).collect()] == [(3, 0)]
    assert decontaminate(some, bench.limit(0)).count() == 1


def test_rule(spark):
    df = spark.createDataFrame([(1, 20), (1, 21), (0, 0), (0, 5)], "h int, n int")
    assert [r[0] for r in df.select(is_contaminated(F.col("h"), F.col("n"))).collect()] == [True, False, False, False]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
