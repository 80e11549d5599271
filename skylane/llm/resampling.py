"""Target-distribution importance resampling over hashed word runs.

Features are all runs of one to three consecutive words; a feature's bucket is
its CRC-32 modulo the number of buckets.  A bucket's gain is the log ratio of
its smoothed share in the target texts to that in the corpus; a document's
weight sums the gains of its features, a Gumbel number drawn from its id is
added, and the highest scores are drawn.

CRC-32 is linear: the state after ``a b`` follows from that after ``a``, the
length of `` b`` and the CRC of `` b`` alone.  So the vocabulary has two parts:

* head: the states of frequent words, and states and buckets of frequent pairs
  of them, counted over all texts (each task keeps its most frequent ones in
  bounded tables, which are added up) and broadcast, at most ``WORDS`` and
  ``PAIRS`` of them;
* tail: every other word's CRC is taken directly, and every other run's state
  is continued from its first words'.

Both give the exact CRC of the feature, so the totals of the buckets are exact,
whatever stands in the head.

Defined results: a NULL or empty text has no features, weight 0; a NULL
``doc_id`` has no Gumbel number: score NULL, never drawn and not counted among
the documents to draw from; repeated rows are documents of their own; ties go
to the smaller id, then to more features, then to the larger weight; a very
long text is read whole; empty tables have no features (all gains are then 0 or
from smoothing) and give no rows.  Only doc_id and the texts are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skylane.llm.common import LOWER, UPPER, shared_table

BUCKETS = 10_000
LONGEST = 3
#: Bounds of the head.
WORDS, PAIRS = 1 << 16, 1 << 17
#: Entries of a task's counters before they are cut to the most frequent, and
#: of a worker's memory of tail words.
COUNTED, REMEMBERED = 1 << 19, 1 << 18
PIECE = 1 << 20

# The word rule, as a map of bytes (A-Z to a-z, other separators
# to a space), and CRC-32's reversed polynomial.
_RULE = np.arange(256, dtype=np.uint8)
_RULE[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = 0x20
_RULE[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]
_RULE = _RULE.tobytes()
_POLYNOMIAL = 0xEDB88320

_U = np.uint32


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_RULE).split() if text else []


def _shift_tables(longest: int = 64) -> np.ndarray:
    """[length][byte of the state][its value]: what zero bytes of that length
    make of a CRC."""
    one = np.zeros(256, np.uint32)
    for value in range(256):
        state = value
        for _ in range(8):
            state = state >> 1 ^ (_POLYNOMIAL if state & 1 else 0)
        one[value] = state
    tables = np.zeros((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << _U(8 * k)
    for length in range(1, longest + 1):
        last = tables[length - 1]
        tables[length] = (last >> _U(8)) ^ one[last & _U(0xFF)]
    return tables


_SHIFTS = _shift_tables()


def extended(states: np.ndarray, lengths: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """CRCs of texts with CRC ``states`` continued by texts of these lengths and
    CRCs ``tails``."""
    out = states
    while len(lengths) and (over := lengths > 64).any():  # long words: 64 bytes at a time
        out = np.where(over, _shifted(out, np.full(len(out), 64)), out)
        lengths = np.where(over, lengths - 64, lengths)
    return _shifted(out, lengths) ^ tails


def _shifted(states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    flat, at = _SHIFTS.ravel(), lengths.astype(np.int64) << 10
    return flat[at + (states & _U(0xFF))] ^ flat[at + 256 + (states >> _U(8) & _U(0xFF))] \
        ^ flat[at + 512 + (states >> _U(16) & _U(0xFF))] ^ flat[at + 768 + (states >> _U(24))]


class Head:
    """Frequent words with their states, and frequent pairs (numbers of words)
    with theirs and their buckets, in a table of one probe each."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.key, self.words, self.buckets = uuid4().hex, words, buckets
        number = {w: i for i, w in enumerate(words)}
        known = np.array([(number[a], number[b]) for a, b in pairs if a in number and b in number], np.int64).reshape(-1, 2)
        slots = 1 << max(1, (2 * len(known)).bit_length())
        self.keys, self.states = np.full(slots, -1, np.int64), np.zeros(slots, np.uint32)
        key = (known[:, 0] << 32) | known[:, 1]
        slot = self.slot(key)
        _, first = np.unique(slot, return_index=True)  # of pairs of one slot, the more frequent is kept
        states = np.fromiter((zlib.crc32(words[a] + b" " + words[b]) for a, b in known[first].tolist()), np.uint32, len(first))
        self.keys[slot[first]], self.states[slot[first]] = key[first], states
        self.bucket = (self.states % _U(buckets)).astype(np.int64)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(-7046029254386353131)) >> np.int64(29)) & np.int64(len(self.keys) - 1)


class Vocabulary(dict):
    """Numbers of words: those of the head, and tail words met lately."""

    def __init__(self, head: Head):
        super().__init__()
        self.head = head
        self.crc: list[int] = []
        self.tail_crc: list[int] = []
        self.length: list[int] = []
        self.arrays: tuple[np.ndarray, ...] = ()
        for w in head.words:
            self[w]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.crc)
        self.crc.append(zlib.crc32(word))
        self.tail_crc.append(zlib.crc32(b" " + word))
        self.length.append(len(word) + 1)
        return number

    def states(self) -> tuple[np.ndarray, ...]:
        """(crc, crc after a space, length with the space) by number."""
        done = len(self.arrays[0]) if self.arrays else 0
        if done < len(self.crc):
            fresh = [np.array(x[done:], t) for x, t in ((self.crc, np.uint32), (self.tail_crc, np.uint32), (self.length, np.int64))]
            self.arrays = tuple(np.concatenate([old, new]) for old, new in zip(self.arrays, fresh)) if done else tuple(fresh)
        return self.arrays


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(head: Head) -> Vocabulary:
    """The worker's vocabulary, begun anew when many tail words have come."""
    own = _vocabularies.get(head.key)
    if own is None or len(own) > len(head.words) + REMEMBERED:
        _vocabularies.clear()
        own = _vocabularies[head.key] = Vocabulary(head)
    return own


def text_buckets(texts: list[str | None], head: Head) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The number of words of each text and, per length of run, (text, bucket)
    of all features."""
    known = vocabulary(head)
    numbers: list[int] = []
    sizes = []
    for text in texts:
        own = words_of(text)
        numbers += map(known.__getitem__, own)
        sizes.append(len(own))
    crc, after, length = known.states()
    ids = np.array(numbers, np.int64)
    sizes = np.array(sizes, np.int64)
    place = np.repeat(np.arange(len(texts)), sizes)
    state = crc[ids] if len(ids) else np.zeros(0, np.uint32)
    out = [(place, (state % _U(head.buckets)).astype(np.int64))]
    for run in range(2, LONGEST + 1):
        same = place[run - 1:] == place[:len(place) - run + 1]
        where = np.flatnonzero(same) + run - 1  # the last word of each run
        state_of = np.zeros(len(ids), np.uint32)
        if run == 2:
            key = (ids[where - 1] << 32) | ids[where]
            slot = head.slot(key)
            hit = head.keys[slot] == key
            state_of[where[hit]] = head.states[slot[hit]]
            bucket = np.empty(len(where), np.int64)
            bucket[hit] = head.bucket[slot[hit]]
            tail = where[~hit]
            state_of[tail] = extended(state[tail - 1], length[ids[tail]], after[ids[tail]])
            bucket[~hit] = state_of[tail] % _U(head.buckets)
        else:
            state_of[where] = extended(state[where - 1], length[ids[where]], after[ids[where]])
            bucket = (state_of[where] % _U(head.buckets)).astype(np.int64)
        out.append((place[where], bucket))
        state = state_of
    return sizes, out


def pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= PIECE):
            size += len(texts[hi] or "")
            hi += 1
        yield texts[lo:hi]
        lo = hi


def find_head(texts: DataFrame, words: int = WORDS, pairs: int = PAIRS, buckets: int = BUCKETS) -> Head:
    """The most frequent words and pairs of the column text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single: Counter = Counter()
        double: Counter = Counter()
        for batch in batches:
            for part in pieces(batch["text"].to_pylist()):
                found_words, found_pairs = piece_counts(part)
                single.update(found_words)
                double.update(found_pairs)
                for counts in (single, double):
                    if len(counts) > COUNTED:
                        kept = counts.most_common(COUNTED // 2)
                        counts.clear()
                        counts.update(dict(kept))
        rows = [(w, None, n) for w, n in single.most_common(words) if n > 1]
        rows += [(a, b, n) for (a, b), n in double.most_common(pairs) if n > 1]
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int64()))],
                              ["a", "b", "n"])
    found = shared_table(texts.select("text").mapInArrow(count, "a binary, b binary, n long")
                         .groupBy("a", "b").agg(F.sum("n").alias("n")), "head")
    first = most_frequent(found.where("b IS NULL"), words)
    second = most_frequent(found.where("b IS NOT NULL"), pairs)
    return Head([bytes(r["a"]) for r in first], [(bytes(r["a"]), bytes(r["b"])) for r in second], buckets)


def piece_counts(texts: list[str | None]) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int]]:
    """How often each word stands in the texts, and each pair that stands there
    twice or more."""
    index: dict[bytes, int] = {}
    numbers: list[int] = []
    for text in texts:
        numbers += [index.setdefault(w, len(index)) for w in words_of(text)]
        numbers.append(-1)
    known, ids = list(index), np.array(numbers, np.int64)
    counts = np.bincount(ids[ids >= 0], minlength=len(known))
    inside = (ids[:-1] >= 0) & (ids[1:] >= 0)
    codes, n = np.unique(ids[:-1][inside] * len(known) + ids[1:][inside], return_counts=True)
    codes, n = codes[n > 1].tolist(), n[n > 1].tolist()
    return dict(zip(known, counts.tolist())), {(known[c // len(known)], known[c % len(known)]): k for c, k in zip(codes, n)}


def most_frequent(counted: DataFrame, most: int) -> list:
    """At most ``most`` rows of the highest counts, most frequent first: those
    above the lowest level (of eight a doubling) that keeps within the bound."""
    level = F.floor(F.log2("n") * 8)
    sizes = {r["level"]: r["rows"] for r in counted.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect()}  # under 512
    least, total = None, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    rows = [] if least is None else counted.where(level >= least).collect()
    return sorted(rows, key=lambda r: (-r["n"], bytes(r["a"]), bytes(r["b"] or b"")))


def bucket_totals(texts: DataFrame, head: Head) -> DataFrame:
    """(target, bucket, n): exact numbers of features of the texts (text,
    target)."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, head_buckets), np.int64)
        for batch in batches:
            side = np.asarray(batch["target"]).astype(np.int64)
            at = 0
            for part in pieces(batch["text"].to_pylist()):
                sizes, features = text_buckets(part, shared.value)
                own = side[at:at + len(part)]
                at += len(part)
                for place, bucket in features:
                    total += np.bincount(own[place] * head_buckets + bucket, minlength=2 * head_buckets).reshape(2, -1)
        target, bucket = np.nonzero(total)
        yield pa.record_batch([pa.array(target), pa.array(bucket), pa.array(total[target, bucket])], ["target", "bucket", "n"])
    head_buckets = head.buckets
    return texts.select("text", "target").mapInArrow(count, "target long, bucket long, n long") \
        .groupBy("target", "bucket").agg(F.sum("n").alias("n"))


def bucket_gains(totals: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket, in thousandths, rounded down."""
    rows = totals.collect()  # twice the number of buckets at most
    counts = np.zeros((2, buckets))
    for r in rows:
        counts[r["target"], r["bucket"]] = r["n"]
    (s, t), (s_all, t_all) = counts, counts.sum(axis=1)
    return np.floor(1000 * np.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))).astype(np.int64)


def weights(docs: DataFrame, head: Head, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_head, own_gains = shared.value
        for batch in batches:
            at = 0
            for part in pieces(batch["text"].to_pylist()):
                sizes, features = text_buckets(part, own_head)
                weight, n = np.zeros(len(part)), np.zeros(len(part), np.int64)
                for place, bucket in features:  # exact in doubles: far below 2**53
                    weight += np.bincount(place, own_gains[bucket], len(part))
                    n += np.bincount(place, minlength=len(part))
                yield pa.record_batch([batch["doc_id"].slice(at, len(part)).cast(pa.int64()), pa.array(sizes), pa.array(n),
                                       pa.array(weight.astype(np.int64))], ["doc_id", "n_words", "n_features", "weight"])
                at += len(part)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """The document's Gumbel number in thousandths, rounded down."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with the column rank: 1, 2, ... of the first ``most`` by score.
    The rows are dealt into ranges of the order; a rank is the place in the
    range after the sizes of those before."""
    order = [F.desc("score"), F.col("doc_id"), F.desc("n_features"), F.desc("weight")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            yield batch.append_column("place", pa.array(np.arange(at + 1, at + 1 + batch.num_rows)))
            at += batch.num_rows
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(place, schema + ", place long") \
        .withColumn("part", F.spark_partition_id())
    placed = shared_table(placed, "placed")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row per range
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "part int, before long")
    rank = F.col("place") + F.col("before")
    return placed.join(F.broadcast(starts), "part").select(*rows.columns, F.when(rank <= most, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             buckets: int = BUCKETS, words: int = WORDS, pairs: int = PAIRS) -> DataFrame:
    """Per document row: doc_id, n_features, weight, score and rank (NULL if not
    drawn): ``percent`` of the documents of at least ``least_words`` words are
    drawn, to be distributed like ``target`` (its column text)."""
    corpus = docs.select("text", F.lit(False).alias("target"))
    both = corpus.unionByName(target.select("text", F.lit(True).alias("target")))
    head = find_head(both, words, pairs, buckets)
    gains = bucket_gains(bucket_totals(both, head), buckets)
    scored = shared_table(weights(docs, head, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scores")
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    kept = ["doc_id", "n_features", "weight", "score"]
    most = percent * scored.where(eligible).count() // 100
    return ranked(scored.where(eligible).select(*kept), most).unionByName(
        scored.where(~eligible).select(*kept, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """A twentieth of the documents, drawn to be distributed like the benchmark."""
    from skylane.llm.common import read_table
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
