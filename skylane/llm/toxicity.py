"""Toxicity scores from a counterfactual-regularised linear classifier.

A document's features are its distinct words (runs of letters and digits,
lower case) and their beginnings of 4 to 7 characters.  Those that stand with
either label more than chance allows are the model's terms; their weights come from logistic regression with a
second loss: in each labelled text that names a group (a religion, an origin,
a gender, an orientation ...) the term is swapped for the others of its kind,
and a change of the score is penalised, so that naming a group in itself does
not raise a score.

The classifier is fitted on a bounded sample: at most about ``train_docs``
labelled documents of each label, chosen by a hash of the id.  Every document
is scored on its whole text.

Defined results: a NULL or empty text scores as a text without any term; a
NULL ``doc_id`` is never learned from (its id text is empty, which is held
out); contradicting or NULL labels of one id are not learned from; without
labels of both kinds every score is the share of label 1 (0 without any label);
repeated rows each get a row.  Only doc_id, text and toxic are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylane.llm.common import shared_table

WORD = re.compile(r"[^\W_]+")
#: Groups of interchangeable identity terms (fixed values, four languages).
IDENTITIES = (
    "women men girls boys frauen männer femmes hommes mujeres hombres",
    "woman man girl boy frau mann femme homme mujer hombre",
    "christians muslims jews hindus buddhists sikhs atheists christen muslime juden chrétiens musulmans juifs "
    "cristianos musulmanes judíos",
    "christian muslim jewish hindu buddhist sikh atheist christlich muslimisch jüdisch chrétien musulman juif "
    "cristiano musulmán judío",
    "black white asian african european latino arab indigenous schwarz weiß noir blanc negro blanco",
    "gay lesbian straight bisexual queer transgender heterosexual homosexual",
    "immigrants refugees foreigners natives einwanderer flüchtlinge immigrés réfugiés inmigrantes refugiados",
    "disabled blind deaf autistic behindert blind sourd ciego sordo",
    "old young elderly teenage alt jung vieux jeune viejo joven",
)
HELD_OUT = 5
BEGINNINGS = (4, 5, 6, 7)
#: Absolute penalty on a weight.
SPARSE = 5e-4


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the terms and the score of a text without any (as log odds)."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        terms = self.weights.keys() & features(text)
        odds = self.bias + math.fsum(self.weights[t] for t in terms)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def features(text: str | None) -> set[str]:
    """The distinct words of a text and their beginnings ("begin*")."""
    found = set(WORD.findall(text.lower())) if text else set()
    return found | {w[:n] + "*" for w in found for n in BEGINNINGS if len(w) > n}


def fold(doc_id) -> F.Column:
    """Remainder of the id's CRC-32; 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT


def training_sample(docs: DataFrame, labels: DataFrame, train_docs: int) -> DataFrame:
    """(words array, toxic) of at most about ``train_docs`` documents of each
    label, none of them held out."""
    clean = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id") \
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")) \
        .where((F.col("toxic") == F.col("_most")) & (fold(F.col("doc_id")) != 0)).select("doc_id", "toxic")
    sizes = {r["toxic"]: r["n"] for r in clean.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("toxic") == label, min(1.0, train_docs / n)).otherwise(share)
    chosen = clean.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(features(t)) for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"].cast(pa.int64()), batch["toxic"].cast(pa.int32()),
                                   pa.array(found, pa.list_(pa.string()))], ["doc_id", "toxic", "words"])
    # at most 2 * train_docs label rows by the shares above
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id") \
        .mapInArrow(run, "doc_id long, toxic int, words array<string>")


def fit(sample: DataFrame, max_terms: int, min_docs: int, strength: float) -> ToxicityModel:
    """Term selection over the sample's counts, then logistic regression in
    one task (the sample is bounded)."""
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.0
        return ToxicityModel({}, 500.0 if share else -500.0)
    counts = sample.select("toxic", F.explode("words").alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
    rate = n1 / (n0 + n1)
    z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    identity = sorted({t for group in IDENTITIES for t in group.split()})
    chosen = counts.where((F.col("n") >= min_docs) & ((F.abs(z) >= 5) | F.col("term").isin(identity))) \
        .orderBy(F.abs(z).desc(), "term").limit(max_terms)
    terms = [r["term"] for r in chosen.select("term").collect()]  # at most max_terms

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        weights, bias = _regression(rows["words"].tolist(), rows["toxic"].to_numpy(float), terms, strength)
        return pd.DataFrame({"term": [*terms, None], "weight": [*weights, bias]})
    held = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    rows = sample.select("toxic", F.array_intersect("words", held).alias("words"))
    fitted = rows.groupBy(F.lit(0).alias("all")).applyInPandas(train, "term string, weight double").collect()
    return ToxicityModel({r["term"]: r["weight"] for r in fitted if r["term"] is not None},
                         next(r["weight"] for r in fitted if r["term"] is None))


def _regression(texts: list[list[str]], labels: np.ndarray, terms: list[str],
                strength: float, steps: int = 400) -> tuple[list[float], float]:
    """Weights and bias by proximal Adam on the mean log loss (each label
    weighs half) and the square of every counterfactual change; the absolute
    penalty leaves a text's signal with the few terms that many texts share,
    not with the words of one copied passage."""
    at = {t: i for i, t in enumerate(terms)}
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    cols = np.array([at[w] for t in texts for w in t], np.int64)
    # a swap of term a for b changes the score by weight b - weight a
    swaps = [(at[w], at[other]) for t in texts for w in t for group in _groups(w)
             for other in group if other != w and other in at]
    old, new = (np.array(x, np.int64) for x in zip(*swaps)) if swaps else (np.zeros(0, np.int64),) * 2
    each = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    k = len(terms)
    theta, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        odds = np.bincount(rows, theta[cols], len(texts)) + theta[k]
        error = (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - labels) * each
        grad = np.append(np.bincount(cols, error[rows], k) + 1e-4 * theta[:k], error.sum())
        if len(old):
            change = 2 * strength * (theta[new] - theta[old]) / len(old)
            grad[:k] += np.bincount(new, change, k) - np.bincount(old, change, k)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        rate = 0.1 / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-6)
        theta -= rate * m / (1 - 0.9 ** step)
        theta[:k] = np.sign(theta[:k]) * np.maximum(0, np.abs(theta[:k]) - rate[:k] * SPARSE)
    return theta[:k].tolist(), float(theta[k])


def _groups(word: str) -> list[list[str]]:
    return [g.split() for g in IDENTITIES if word in g.split()]


def train_toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = 10_000, max_terms: int = 20_000,
                   min_docs: int = 5, strength: float = 1.0) -> ToxicityModel:
    """The classifier from labelled documents that are not held out."""
    sample = shared_table(training_sample(docs, labels, train_docs), "toxicity-sample")
    return fit(sample, max_terms, min_docs, strength)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch["text"]]
            yield pa.record_batch([batch["doc_id"].cast(pa.int64()), batch["held_out"], pa.array(scores, pa.float64())],
                                  ["doc_id", "held_out", "score"])
    return docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text") \
        .mapInArrow(run, "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the labels outside the
    held-out fold."""
    from skylane.llm.common import read_table
    docs = read_table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))
