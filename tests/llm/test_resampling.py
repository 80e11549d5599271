import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from skylane.llm import resampling
from skylane.llm.resampling import Head, extended, find_head, resample, text_buckets
from tests.llm.conftest import documents

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def features(text, buckets):
    w = WORD.findall((text or "").encode().translate(LOWER))
    return len(w), [zlib.crc32(b" ".join(w[i:i + k])) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, buckets=10_000, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x, buckets)[1])
    for x in target:
        t.update(features(x, buckets)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    rows = []
    for i, x in docs:
        n, f = features(x, buckets)
        weight, score = sum(map(gain, f)), None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, n])
    able = sorted((r for r in rows if r[5] >= least and r[3] is not None), key=lambda r: (-r[3], r[0], -r[1], -r[2]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def texts(rng, n):
    vocab = [f"w{i}" for i in range(50)] + ["É", "naïve", "日本", "x" * 200, "Big", "don't", "a_b", "3.14"]
    return [" ".join(rng.choices(vocab, [1 / (k + 1) for k in range(len(vocab))], k=rng.choice([0, 1, 2, 3, 19, 20, 60]))) for _ in range(n)]


@pytest.mark.parametrize("words,pairs,percent", [(1 << 16, 1 << 17, 5), (3, 2, 50), (0, 0, 100)])
def test_against_brute_force(spark, monkeypatch, words, pairs, percent):
    monkeypatch.setattr(resampling, "REMEMBERED", 20)
    rng = random.Random(words)
    docs = list(enumerate(texts(rng, 300))) + [(None, "w1 " * 30), (900, None), (901, ""), (7, "w0 w1 " * 40), (7, "w0 w1 " * 40)]
    target = texts(rng, 20) + [None]
    got = resample(documents(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"),
                   words=words, pairs=pairs, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, percent=percent)


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a b"), (2, "w " * 25)])
    assert resample(none, none).count() == 0
    assert resample(none, some).count() == 0
    assert sorted(map(tuple, resample(some, none, percent=100).collect())) == brute([(1, "a b"), (2, "w " * 25)], [], percent=100)


def test_continued_states():
    rng = random.Random(1)
    a = [rng.randbytes(rng.randrange(0, 9)) for _ in range(500)]
    b = [rng.randbytes(rng.choice([1, 5, 63, 64, 65, 128, 300])) for _ in range(500)]
    got = extended(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([len(x) for x in b]),
                   np.array([zlib.crc32(x) for x in b], np.uint32))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_long_text_and_bounded_counters(spark, monkeypatch):
    """One text of a million words: counters are cut, results stay exact."""
    rng = random.Random(2)
    text = " ".join(f"u{rng.randrange(200_000)}" for _ in range(300_000))
    sizes, found = text_buckets([text], Head([b"u1", b"u2"], [(b"u1", b"u2")], 97))
    n, want = features(text, 97)
    assert sizes.tolist() == [n]
    assert sum(np.bincount(b, minlength=97) for _, b in found).tolist() == [Counter(want)[k] for k in range(97)]
    monkeypatch.setattr(resampling, "COUNTED", 100)
    head = find_head(documents(spark, [(1, "often often rare " * 3 + text[:20_000])]), 5, 5)
    assert b"often" in head.words


def test_ties_go_to_the_smaller_id(spark):
    rows = spark.createDataFrame([(i, 5, 1, 10 + (i % 2)) for i in range(1, 201)], "doc_id long, n_features long, weight long, score long")
    got = {r.doc_id: r["rank"] for r in resampling.ranked(rows, 150).collect()}
    order = sorted(range(1, 201), key=lambda i: (-(i % 2), i))
    assert got == {i: (k + 1 if k < 150 else None) for k, i in enumerate(order)}
