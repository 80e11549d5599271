import random
import zlib

from skylane.llm.toxicity import score_toxicity, train_toxicity
from tests.llm.conftest import documents


def corpus():
    rng = random.Random(5)
    plain = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 40))]
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["Scum!", "LOSER", "moron."]))
        if rng.random() < (0.5 if bad else 0.1):
            words.append("muslims")  # named more often in toxic texts
        if rng.random() < (0.1 if bad else 0.3):
            words.append("christians")
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_and_counterfactual(spark):
    docs, labels = corpus()
    d, l = documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = train_toxicity(d, l)
    want = dict(labels)
    rows = score_toxicity(d, model).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == want[r.doc_id] for r in held) / len(held) > 0.95
    gap = abs(model.score("some neutral muslims") - model.score("some neutral christians"))
    free = train_toxicity(d, l, strength=0.0)
    assert gap < 0.1 and gap < abs(free.score("some neutral muslims") - free.score("some neutral christians"))
    assert model.score("all muslims are scum") > 0.5 > model.score("muslims word1 word2")


def test_edge_cases(spark):
    docs, labels = corpus()
    model = train_toxicity(documents(spark, docs), spark.createDataFrame(
        labels + [(0, 0), (None, 1), (3, None)], "doc_id long, toxic int"))
    rows = score_toxicity(documents(spark, [(1, None), (2, ""), (None, "scum"), (2, ""), (3, "x " * 50000 + "loser")]), model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id: r.predicted for r in rows} == {1: 0, 2: 0, None: 1, 3: 1}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = train_toxicity(documents(spark, docs), none)
    assert {r.predicted for r in score_toxicity(documents(spark, docs[:3]), empty).collect()} == {0}
    assert score_toxicity(documents(spark, []), model).count() == 0
