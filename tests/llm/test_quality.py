import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from skylane.llm import quality
from skylane.llm.quality import classify, discounts, keep_good, perplexities, train
from tests.llm.conftest import documents


def brute_bits(texts, scored):
    """Interpolated modified Kneser-Ney over symbol runs, with dictionaries."""
    kinds = quality.symbol_table()
    seq = lambda t: [quality.START] * 3 + [int(kinds[min(ord(c), len(kinds) - 1)]) for c in t]
    counts = [None] * 5
    counts[4] = Counter(tuple(s[i - 3:i + 1]) for t in texts for s in [seq(t)] for i in range(3, len(s)))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut, total, taken = {}, defaultdict(float), defaultdict(float)
    for n in range(1, 5):
        of = Counter(counts[n].values())
        cut[n] = discounts([of[k] for k in (1, 2, 3, 4)])
        for g, c in counts[n].items():
            total[g[:-1], n] += c
            taken[g[:-1], n] += cut[n][min(c, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / 63
        n, h = len(gram), gram[:-1]
        if (h, n) not in total:
            return p(gram[1:])
        c = counts[n][gram]
        own = (c - cut[n][min(c, 3) - 1]) / total[h, n] if c else 0
        return own + taken[h, n] / total[h, n] * p(gram[1:])
    s = seq(scored)
    return [-math.log2(p(tuple(s[i - 3:i + 1]))) for i in range(3, len(s))]


def test_model_against_brute_force(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcde é.\nAB") for _ in range(rng.randrange(0, 60))) for _ in range(30)]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)] + [(99, None)])
    model = train(docs)
    table = model.bits()
    assert np.allclose((2.0 ** -table.reshape(-1, 64))[:, :63].sum(axis=1), 1, atol=1e-4)
    scored = texts[:5] + ["zzz !!! 東京", "a" * 5000, ""]
    rows = perplexities(documents(spark, list(enumerate(scored))), model, [F.col("doc_id")]).collect()
    for r in rows:
        want = brute_bits(texts, scored[r.doc_id])
        if not want:
            assert r.perplexity is None
        else:
            assert abs(math.log2(r.perplexity) - sum(want) / len(want)) < 1e-3


def test_classify_and_edge_cases(spark):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat."]) for _ in range(80))
    rows = [(i, good(), "en") for i in range(60)] + [(100, "%%$$ ##@@ !!" * 30, "en"), (101, None, "en"), (102, "", None),
                                                     (103, good(), "xx"), (None, good(), None), (5, good(), "en")]
    docs = documents(spark, rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 50)] + [(100, 0), (7, 0), (None, 1), (8, None)],
                                   "doc_id long, quality int")
    got = classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.kept} == {100, 101, 102}
    left = keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == len(rows) - 3
    nothing = classify(docs, labels.limit(0)).collect()
    assert {r.doc_id for r in nothing if not r.kept} == {101, 102} and all(r.threshold is None for r in nothing)
    assert classify(docs.limit(0), labels).count() == 0


def test_letters_of_every_script_count(spark):
    """Strings of a script's letters that are no words of it are rejected, new
    text of its words is kept."""
    rng = random.Random(3)
    scripts = {"ru": ("абвгдежзиклмнопрстуя", " "), "el": ("αβγδεζηθικλμνξοπρστυ", " "),
               "zh": ("的一是不了人我在有他这中大来上国个到说们", ""), "en": ("abcdefghijklmnopqrst", " ")}
    rows = []
    for k, (lang, (letters, gap)) in enumerate(scripts.items()):
        known = ["".join(rng.choice(letters[:12]) for _ in range(rng.randrange(2, 8))) for _ in range(40)]
        same = [["".join(rng.choice(letters[8:]) for _ in w) for w in known] for _ in range(20)]
        rows += [(1000 * k + i, gap.join(rng.choice(known) for _ in range(120)) + ".", lang) for i in range(60)]
        rows += [(1000 * k + 900 + i, gap.join(rng.choice(s) for _ in range(120)) + ".", lang) for i, s in enumerate(same)]
    labels = spark.createDataFrame([(1000 * k + i, 1) for k in range(4) for i in range(50)], "doc_id long, quality int")
    got = classify(documents(spark, rows, "doc_id long, text string, lang string"), labels).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.kept and r.doc_id % 1000 >= 900} == {r[0] for r in rows if r[0] % 1000 >= 900}
    assert sum(not r.kept for r in got if 50 <= r.doc_id % 1000 < 900) <= 2


def test_words_against_brute_force(spark, monkeypatch):
    """The joined sums are the Kneser-Ney bits of the words, whatever goes to
    the tasks and whatever is broadcast."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "on", "é1", "."]) for _ in range(rng.randrange(1, 30))) for _ in range(25)]
    trusted = documents(spark, list(enumerate(texts)))
    scored = [texts[0], texts[0], "the dog sat on   mats", "  \n", "東京 the", "", None]
    spelling = train(trusted).bits()
    spelled = lambda w: float(quality.text_bits([w + " "], spelling, quality.member_bits())[0])
    pairs = Counter(p for t in texts for s in [["", *quality.words(t), ""]] for p in zip(s, s[1:]))
    follow = Counter(w for _, w in pairs)
    cuts = [discounts([list(c.values()).count(k) for k in (1, 2, 3, 4)]) for c in (follow, pairs)]
    cut = lambda c, n: c[min(n, 3) - 1]
    total, taken = Counter(), defaultdict(float)
    for (u, _), n in pairs.items():
        total[u] += n
        taken[u] += cut(cuts[1], n)
    types, left = sum(follow.values()), sum(cut(cuts[0], n) for n in follow.values()) / sum(follow.values())

    def bits(text):
        out, s = 0.0, ["", *quality.words(text), ""]
        for u, w in zip(s, s[1:]):
            n = follow[w]
            p = (n - cut(cuts[0], n) if n else 0) / types + left * 2 ** -spelled(w)
            if total[u]:
                n = pairs[u, w]
                p = ((n - cut(cuts[1], n) if n else 0) + taken[u] * p) / total[u]
            out -= math.log2(p)
        return out
    docs = documents(spark, list(enumerate(scored))).selectExpr(
        "doc_id", "xxhash64(text) text_hash", "'x' lang", f"{quality.ALL} model", "text")
    for hot, rows in ((quality.HOT, quality.BROADCAST_ROWS), (5, 0), (1, 0)):
        monkeypatch.setattr(quality, "BROADCAST_ROWS", rows)
        for r in quality.word_perplexities(docs, quality.train_words(trusted, hot)).collect():
            text = scored[r.doc_id]
            if not text:
                assert r.perplexity is None
            else:
                assert abs(math.log2(r.perplexity) * len(text) - bits(text)) < 1e-2 * len(text)


def test_packed_keys_are_short_and_whole():
    """Keys packed by ranges come back as they were, in at most 10 bytes each."""
    rng = np.random.default_rng(6)
    key, place, n = rng.integers(-1 << 63, (1 << 63) - 1, 40_000), rng.integers(0, 900, 40_000), rng.integers(1, 200, 40_000)
    key[:500] = key[500:1000]
    found, size = [], 0
    for _, first, count, *raw in quality.packed(place, key, n, 5):
        steps, places, counts = (quality.from_planes(r, count) for r in raw)
        keys = (np.uint64(first % (1 << 64)) + np.cumsum(steps, dtype=np.uint64)).view(np.int64)
        found += zip(places.tolist(), keys.tolist(), counts.tolist())
        size += sum(map(len, raw))
    assert sorted(found) == sorted(zip(place.tolist(), key.tolist(), n.tolist()))
    assert size <= 10 * len(key)


def test_scores_whatever_the_buckets_and_chunks(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "mats", "é1"]) for _ in range(rng.randrange(1, 20))), rng.choice(["en", None]))
            for i in range(40)] + [(41, None, "en"), (42, "", None), (None, "the cat", "en")]
    docs = documents(spark, rows, "doc_id long, text string, lang string")
    model = quality.train_words(docs.where("doc_id < 30").select("doc_id", "text"), 1)
    asked = docs.selectExpr("doc_id", "xxhash64(text) text_hash", "lang", "int(coalesce(doc_id, 0) % 3) model", "text")
    whole = {r.doc_id: r for r in quality.word_perplexities(asked, model).collect()}
    monkeypatch.setattr(quality, "MET", 3)
    monkeypatch.setattr(quality, "PACKED", 1)
    parts = quality.word_perplexities(asked, model).collect()
    assert len(parts) == len(rows) and set(whole) == {r[0] for r in rows}
    for r in parts:
        want = whole[r.doc_id]
        assert (r.text_hash, r.lang) == (want.text_hash, want.lang)
        assert r.perplexity == want.perplexity or abs(r.perplexity / want.perplexity - 1) < 1e-9
