"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model's tokens are words (runs of letters, runs of digits, every other
character alone; characters of scripts without spaces alone), and its runs are
pairs of words.  All pairs and words of all trusted documents are counted in
DataFrames that grow with the corpus.  A word that the model lacks is spelled:
a Kneser-Ney model of character classes (``SYMBOLS`` of them, in runs of
``ORDER``, so its tables are at most ``SYMBOLS ** ORDER`` cells) and the number
of characters of each class give every string a probability.

A text starts and ends with the same empty word, so each of its words is
predicted once and a context once.  Its bits are then a sum over its distinct
words and pairs: what spelling each word would take (known where the text is
read), a difference for each word that the model knows, and a difference for
each pair that it knows.  Differences of frequent words and pairs (``HOT``) are
sent to the tasks; the others meet the documents' words and pairs, packed by
ranges of their keys, in groups, and are summed per document.

Every document gets the perplexity per character of its whole text.  A document
is rejected when its perplexity is above its language's quantile over all
trusted documents, with a margin.  Trusted documents are scored by the model of
the half of the trusted texts that they are not in (halves by the text's hash):
their own words would otherwise look likelier than those of any new text.  All
others are scored by the model of all trusted texts.

Defined results: a NULL or empty text has no perplexity and is rejected; a NULL
language is a language of its own; a language without trusted documents takes
the quantile over all of them; without any trusted document nothing with text
is rejected (threshold NULL); contradicting or NULL labels of an id do not
count; repeated rows each get a row; documents of one perplexity share a verdict; a
very long text is read whole by one task, a piece at a time where it is counted;
an empty table gives no rows.  Only
doc_id, text, lang, and the labels' doc_id and quality are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from skylane.llm.common import broadcast_if_small, drop_tables, forget_shuffles, join_counted, kept, shared_table

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
START = 63
QUANTILE = 0.99
MARGIN = 1.1
BROADCAST_ROWS = 1_000_000
PIECE = 1 << 20
#: Words and pairs with at least this part of a model's tokens go to the tasks
#: (at most so many words and pairs of each model).
HOT = 200_000
#: Pairs that a task counts before it passes them on.
COUNTED = 1 << 20
#: Words that more than this part of the pairs hold are broadcast to them.
HOT_WORDS = 100_000
#: About so many of a model's words and pairs meet the documents' in one group;
#: a task packs about so many of its documents' together.
MET, PACKED = 1 << 19, 1 << 20

# The models (of either half of the trusted texts, and of all).
ALL, MODELS = 2, 3

# The word rule.  Scripts without spaces between words.
SPACELESS = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
WORD = re.compile(r"[^\W\d_]+|\d+|  +|[^\w ]|_")
MIXED_WORD = re.compile(rf"{SPACELESS}|(?:(?!{SPACELESS})[^\W\d_])+|\d+|  +|[^\w ]|_")
HAS_SPACELESS = re.compile(SPACELESS)


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """The symbol of each code point below 0x3000 and, last, of all others."""
    kinds = np.full(0x3000 + 1, 62, np.uint8)
    kinds[-1] = 57
    for code in range(0x3000):
        c = chr(code)
        if "a" <= c <= "z":
            kinds[code] = code - ord("a")
        elif "A" <= c <= "Z":
            kinds[code] = 26 + code - ord("A")
        elif c.isdigit():
            kinds[code] = 52
        elif c == "\n":
            kinds[code] = 53
        elif c.isspace():
            kinds[code] = 54
        elif c == ".":
            kinds[code] = 55
        elif c == ",":
            kinds[code] = 56
        elif c.isalpha():
            kinds[code] = 58 if c.isupper() else 57
        elif c in "'\"-():;?":
            kinds[code] = 59
        elif unicodedata.category(c)[0] in "PS":
            kinds[code] = 60 if code < 128 else 61
    return kinds


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each after ``ORDER - 1`` start symbols, and the
    texts' lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = symbol_table()
    out = np.full(len(codes) + (ORDER - 1) * len(texts), START, np.uint8)
    place = np.arange(len(codes)) + np.repeat((ORDER - 1) * np.arange(1, len(texts) + 1), lengths)
    out[place] = kinds[np.minimum(codes, len(kinds) - 1)]
    return out, lengths


def pieces(texts: list[str]) -> Iterator[list[str]]:
    """The texts in turn, about ``PIECE`` characters at once."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= PIECE):
            size += len(texts[hi])
            hi += 1
        yield texts[lo:hi]
        lo = hi


def runs(kinds: np.ndarray) -> np.ndarray:
    """The run of ``ORDER`` symbols that ends at each symbol from the
    ``ORDER``-th on, as one number."""
    out = kinds[:len(kinds) - ORDER + 1].astype(np.uint32)
    for i in range(1, ORDER):
        out = (out << BITS) | kinds[i:len(kinds) - ORDER + 1 + i]
    return out


def run_counts(docs: DataFrame) -> DataFrame:
    """(run, n) over all texts of ``docs``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** ORDER, np.int32)
        for batch in batches:
            for texts in pieces([t for t in batch["text"].to_pylist() if t]):
                kinds, _ = symbols(texts)
                for lo in range(0, len(kinds) - ORDER + 1, PIECE):  # one text may be longer than a piece
                    found, n = np.unique(runs(kinds[lo:lo + PIECE + ORDER - 1]), return_counts=True)
                    total[found] += n.astype(np.int32)
        found = np.flatnonzero(total)
        found = found[found % SYMBOLS != START]  # a start symbol is never predicted
        yield pa.record_batch([pa.array(found.astype(np.int64)), pa.array(total[found].astype(np.int64))], ["run", "n"])
    return docs.select("text").mapInArrow(count, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageModel:
    """Per order, the runs' own shares (run, share) and the weights that
    contexts leave to the next lower order (context, weight)."""

    shares: list[tuple[np.ndarray, np.ndarray]]
    weights: list[tuple[np.ndarray, np.ndarray]]
    key: str = field(default_factory=lambda: uuid4().hex)

    def bits(self) -> np.ndarray:
        """Bits of each run's last symbol given the others, for all runs."""
        below = np.full(1, 1 / (SYMBOLS - 1))
        for (run, share), (context, weight) in zip(self.shares, self.weights):
            size = len(below) if len(below) > 1 else 1
            left = np.ones(max(1, size), np.float32)
            left[context] = weight
            # contexts lead with the symbol that the lower order lacks
            table = (left[:, None] * np.tile(below.reshape(-1, SYMBOLS) if size > 1 else np.full((1, SYMBOLS), below[0]),
                                             (SYMBOLS if size > 1 else 1, 1))).ravel().astype(np.float32)
            table[run] += share
            below = table
        return -np.log2(np.maximum(below, 1e-12))


def _bits(model: LanguageModel) -> np.ndarray:
    return kept(f"bits-{model.key}", model.bits)


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many runs have count 1 to 4."""
    n1, n2, n3, n4 = (max(0, n) for n in counts)
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), k) for d, k in zip((1 - 2 * y * n2 / n1, d2, d3), (0.95, 1.95, 2.95)))


def train(trusted: DataFrame) -> LanguageModel:
    """The model of all texts of ``trusted``.  At most ``SYMBOLS ** ORDER`` runs
    come to the driver, whatever the number of documents."""
    counted = shared_table(run_counts(trusted), "runs-4")
    orders = [counted]
    for order in range(ORDER - 1, 0, -1):  # in how many contexts a shorter run is seen
        mask = (1 << (BITS * order)) - 1
        shorter = orders[0].groupBy(F.col("run").bitwiseAND(F.lit(mask)).alias("run")).agg(F.count("*").alias("n"))
        orders.insert(0, shared_table(shorter, f"runs-{order}"))
    shares, weights = [], []
    for runs_n in orders:
        of_counts = {r["n"]: r["runs"] for r in runs_n.where("n <= 4").groupBy("n").agg(F.count("*").alias("runs")).collect()}
        d1, d2, d3 = discounts([of_counts.get(k, 0) for k in (1, 2, 3, 4)])
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        named = runs_n.withColumn("context", F.shiftright("run", BITS))
        contexts = named.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount).alias("taken"))
        joined = named.join(contexts, "context").select(
            "run", ((F.col("n") - discount) / F.col("total")).alias("share"))
        share = joined.toArrow()
        weight = contexts.select("context", (F.col("taken") / F.col("total")).alias("weight")).toArrow()
        shares.append((share["run"].to_numpy(), share["share"].to_numpy().astype(np.float32)))
        weights.append((weight["context"].to_numpy(), weight["weight"].to_numpy().astype(np.float32)))
    return LanguageModel(shares, weights)


def text_bits(texts: list[str], bits: np.ndarray, members: np.ndarray | None = None) -> np.ndarray:
    """Bits of each text's symbols and, with ``members`` (bits per symbol), of
    its characters among those of the same symbol."""
    kinds, lengths = symbols(texts)
    sums = np.zeros(max(0, len(kinds) - ORDER + 1) + 1)
    if len(sums) > 1:
        each = bits[runs(kinds)]
        if members is not None:
            each = each + members[kinds[ORDER - 1:]]
        each[kinds[ORDER - 1:] == START] = 0
        np.cumsum(each, out=sums[1:])
    ends = np.cumsum(lengths + ORDER - 1) - (ORDER - 1)
    return sums[np.maximum(ends, 0)] - sums[np.maximum(ends - lengths, 0)]


def perplexities(docs: DataFrame, model: LanguageModel, keep: list[Column]) -> DataFrame:
    """The columns ``keep`` and each text's perplexity per character, by
    character classes alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _bits(shared.value)
        for batch in batches:
            values: list[float | None] = []
            for texts in pieces([t or "" for t in batch["_scored"].to_pylist()]):
                values += [float(2 ** (b / len(t))) if t else None for t, b in zip(texts, text_bits(texts, bits).tolist())]
            yield batch.drop_columns(["_scored"]).append_column("perplexity", pa.array(values, pa.float64()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", perplexity double"
    return docs.select(*keep, F.col("text").alias("_scored")).mapInArrow(score, schema)


def words(text: str) -> list[str]:
    """The words of a text."""
    return (MIXED_WORD if HAS_SPACELESS.search(text) else WORD).findall(text)


@lru_cache(maxsize=1)
def member_bits() -> np.ndarray:
    """Per symbol, bits that tell its characters apart."""
    counts = np.bincount(symbol_table()[:-1], minlength=SYMBOLS)
    return np.log2(np.maximum(counts, 1)).astype(np.float32)


def pair_keys(contexts: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The keys of pairs of word hashes (``pair_key`` as a column)."""
    return contexts ^ (following << np.uint64(17) | following >> np.uint64(47))


def pair_key(context: str, following: str) -> Column:
    w = F.col(following)
    return F.col(context).bitwiseXOR(F.shiftleft(w, 17).bitwiseOR(F.shiftrightunsigned(w, 47)))


class WordPiece:
    """The words of some texts: ``ids`` (numbers of distinct words, each text's
    after the empty word's 0), ``following`` (the id after each), ``place`` (the
    text of each), and the distinct words' hashes and bits of spelling."""

    def __init__(self, texts: list[str], bits: np.ndarray):
        index = {"": 0}
        ids: list[int] = []
        sizes = []
        for text in texts:
            before = len(ids)
            ids.append(0)
            ids += [index.setdefault(w, len(index)) for w in words(text)]
            sizes.append(len(ids) - before)
        self.size = len(index)
        self.ids = np.array(ids, np.int64)
        self.following = np.append(self.ids[1:], 0)
        self.place = np.repeat(np.arange(len(texts)), sizes)
        self.hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in index), np.uint64, self.size)
        self.spelled = text_bits([w + " " for w in index], bits, member_bits())

    def pairs(self, group: np.ndarray) -> tuple[np.ndarray, ...]:
        """(group, context, word, n) of the distinct pairs of each group."""
        code, n = np.unique((group * self.size + self.ids) * self.size + self.following, return_counts=True)
        rest, word = np.divmod(code, self.size)
        group, context = np.divmod(rest, self.size)
        return group, context, word, n

    def counts(self, group: np.ndarray) -> tuple[np.ndarray, ...]:
        """(group, word, n) of the distinct words of each group."""
        code, n = np.unique(group * self.size + self.ids, return_counts=True)
        group, word = np.divmod(code, self.size)
        return group, word, n


def text_half() -> Column:
    return F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")


class PairTable:
    """Counts of pairs (u, w) by half, bounded by ``COUNTED`` rows."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, u: np.ndarray, w: np.ndarray, half: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((u, w, np.where(half == 0, n, 0), np.where(half == 1, n, 0)))
        self.size += len(u)
        if self.size > COUNTED:
            self.merge()

    def merge(self) -> None:
        u, w, n0, n1 = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])]))
        self.parts = [(u[first], w[first], np.add.reduceat(n0[order], first), np.add.reduceat(n1[order], first))]
        self.size = len(first)

    def taken(self) -> tuple[np.ndarray, ...]:
        """All counts; the table is empty afterwards."""
        self.merge()
        found, self.parts, self.size = self.parts[0], [], 0
        return found


def pair_counts(trusted: DataFrame, spelling: LanguageModel) -> DataFrame:
    """(u, w, n0, n1, spelled): the pairs of words of all texts of ``trusted``,
    counted in either half; and the spelling of each word w, where u is NULL."""
    shared = trusted.sparkSession.sparkContext.broadcast(spelling)

    def rows(u: np.ndarray | None, w: np.ndarray, n0: np.ndarray, n1: np.ndarray, spelled: np.ndarray | None) -> pa.RecordBatch:
        nothing = [None] * len(w)
        return pa.record_batch([
            pa.array(nothing if u is None else u.view(np.int64), pa.int64()), pa.array(w.view(np.int64)), pa.array(n0, pa.int64()),
            pa.array(n1, pa.int64()), pa.array(nothing if spelled is None else spelled, pa.float64())], ["u", "w", "n0", "n1", "spelled"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, told = _bits(shared.value), PairTable(), set()
        for batch in batches:
            known = [(t, h) for t, h in zip(batch["text"].to_pylist(), batch["half"].to_pylist()) if t]
            at = 0
            for texts in pieces([t for t, _ in known]):
                piece = WordPiece(texts, bits)
                half, context, word, n = piece.pairs(np.array([h for _, h in known[at:at + len(texts)]], np.int64)[piece.place])
                at += len(texts)
                held.add(piece.hashes[context], piece.hashes[word], half, n)
                fresh = np.array([i for i, h in enumerate(piece.hashes.tolist()) if h not in told], np.int64)
                if len(told) > COUNTED:
                    told.clear()
                told.update(piece.hashes[fresh].tolist())
                zero = np.zeros(len(fresh), np.int64)
                yield rows(None, piece.hashes[fresh], zero, zero, piece.spelled[fresh])
                if held.size > COUNTED * 3 // 4:
                    yield rows(*held.taken(), None)
        if held.size:
            yield rows(*held.taken(), None)
    return trusted.select("text", text_half().alias("half")) \
        .mapInArrow(count, "u long, w long, n0 long, n1 long, spelled double") \
        .groupBy("u", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.max("spelled").alias("spelled"))


def of_model(model: int) -> Column:
    """The model's count of a pair."""
    return F.col("n0") + F.col("n1") if model == ALL else F.col(f"n{model}")


def discounted(counted: DataFrame, counts: list[Column]) -> list[Column]:
    """Each model's discount of its count in ``counts``: 0 of none."""
    seen = counted.agg(*[F.count(F.when(c == k, 1)).alias(f"c{m}_{k}") for m, c in enumerate(counts) for k in (1, 2, 3, 4)]).first()
    out = []
    for m, c in enumerate(counts):
        d1, d2, d3 = discounts([seen[f"c{m}_{k}"] for k in (1, 2, 3, 4)])
        out.append(F.when(c > 2, d3).when(c == 2, d2).when(c == 1, d1).otherwise(0.0))
    return out


@dataclass(frozen=True)
class WordModel:
    """``table``: (key, delta of each model, hot) of words and pairs, those not
    hot to be joined; ``keys`` (sorted) and ``deltas`` of the hot ones;
    ``unknown``: per model, the bits before a word is spelled."""

    spelling: LanguageModel
    unknown: np.ndarray
    keys: np.ndarray
    deltas: np.ndarray
    table: DataFrame


def train_words(trusted: DataFrame, hot: int = HOT) -> WordModel:
    """The models of all texts of ``trusted``."""
    spelling = train(trusted)
    counted = shared_table(pair_counts(trusted, spelling), "word-pairs")
    forget_shuffles(trusted.sparkSession)  # the counts are written
    pairs, models = counted.where("u IS NOT NULL"), range(MODELS)
    cut = discounted(pairs, [of_model(m) for m in models])
    contexts = pairs.groupBy(F.col("u").alias("w")).agg(
        *[F.sum(of_model(m)).alias(f"total{m}") for m in models], *[F.sum(cut[m]).alias(f"taken{m}") for m in models],
        F.count("*").alias("as_context"))
    # every word is predicted somewhere and a context somewhere
    known = counted.groupBy("w").agg(
        *[F.count(F.when(of_model(m) > 0, 1)).alias(f"follow{m}") for m in models], F.max("spelled").alias("spelled"),
        F.count("u").alias("as_word")).join(contexts, "w")
    known = known_table = shared_table(known, "words")
    forget_shuffles(trusted.sparkSession)  # the words are written
    cut_word = discounted(known, [F.col(f"follow{m}") for m in models])
    sums = known.agg(*[F.sum(c).alias(f"{name}{m}") for m in models for name, c in (
        ("n", F.col(f"follow{m}")), ("cut", cut_word[m]), ("tokens", F.col(f"total{m}")))]).first()  # one row
    unknown = np.array([-math.log2(sums[f"cut{m}"] / sums[f"n{m}"]) if sums[f"n{m}"] else 0.0 for m in models])
    log = lambda c: F.log2(F.greatest(c, F.lit(1e-300)))
    often = [max(1.0, float(sums[f"tokens{m}"] or 0) / hot) for m in models]

    def is_hot(counts: list[Column]) -> Column:
        return F.greatest(*[(c >= often[m]).cast("int") for m, c in enumerate(counts)]) == 1
    for m in models:
        known = known.withColumn(f"left{m}", F.try_divide(f"taken{m}", f"total{m}")).withColumn(
            f"p{m}", F.when(F.col(f"follow{m}") > 0, (F.col(f"follow{m}") - cut_word[m]) / F.lit(float(sums[f"n{m}"] or 1))
                            + F.pow(F.lit(2.0), -(F.col("spelled") + float(unknown[m])))))
    of_words = known.select(F.col("w").alias("key"), *[
        (-log(F.col(f"left{m}")) - log(F.col(f"p{m}")) - F.col("spelled") - float(unknown[m])).cast("float").alias(f"delta{m}")
        for m in models], is_hot([F.col(f"total{m}") for m in models]).alias("hot"))
    first = known.select(F.col("w").alias("u"), *[c for m in models for c in (f"total{m}", f"left{m}")], "as_context")
    second = known.select("w", *[f"p{m}" for m in models], "as_word")
    # what a pair needs of its words goes along in single precision, and nothing else
    both = join_counted(pairs.select("u", "w", "n0", "n1"), first, ["u"], "as_context", HOT_WORDS).select(
        pair_key("u", "w").alias("key"), "w", "n0", "n1",
        *[F.try_divide(of_model(m) - cut[m], F.col(f"total{m}")).cast("float").alias(f"share{m}") for m in models],
        *[F.col(f"left{m}").cast("float").alias(f"left{m}") for m in models])
    both = join_counted(both, second, ["w"], "as_word", HOT_WORDS)
    of_pairs = both.select("key", *[
        F.when(of_model(m) > 0, -log(F.col(f"share{m}").cast("double") + F.col(f"left{m}").cast("double") * F.col(f"p{m}"))
               + log(F.col(f"left{m}").cast("double")) + log(F.col(f"p{m}"))).cast("float").alias(f"delta{m}")
        for m in models], is_hot([of_model(m) for m in models]).alias("hot"))
    deltas = shared_table(of_words.unionByName(of_pairs), "deltas")
    drop_tables(counted, known_table)
    frequent = deltas.where("hot").drop("hot").toArrow()  # at most `hot` words and `hot` pairs of each model
    keys = frequent["key"].to_numpy()
    order = np.argsort(keys)
    values = np.column_stack([frequent[f"delta{m}"].to_numpy() for m in models])[order]
    return WordModel(spelling, unknown, keys[order], values, deltas)


def planes(x: np.ndarray) -> bytes:
    """Whole numbers byte by byte, lowest bytes first, without leading zeros."""
    width = max(1, -(-int(x.max()).bit_length() // 8))
    return x.view(np.uint8).reshape(len(x), x.itemsize)[:, :width].T.tobytes()


def from_planes(raw: bytes, size: int) -> np.ndarray:
    """The ``size`` numbers of ``planes``."""
    out = np.zeros((size, 8), np.uint8)
    out[:, :len(raw) // size] = np.frombuffer(raw, np.uint8).reshape(-1, size).T
    return out.view(np.uint64).ravel()


def packed(place: np.ndarray, key: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[tuple]:
    """(bucket, first key, size, steps to the next keys, places, counts) of the
    keys of each bucket, in order."""
    key = key.view(np.uint64)
    order = np.argsort(key)
    key, place, n = key[order], place[order].astype(np.uint64), n[order].astype(np.uint64)
    steps = np.diff(key, prepend=key[:1])
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(key)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            steps[a] = 0
            yield int(bucket[a]), int(key[a].view(np.int64)), b - a, planes(steps[a:b]), planes(place[a:b]), planes(n[a:b])


def key_bucket(buckets: int) -> Column:
    """The bucket of ``packed`` of the column ``key``."""
    return F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(buckets).cast("long"), 32).cast("int")


def word_perplexities(docs: DataFrame, model: WordModel) -> DataFrame:
    """``docs`` (doc_id, text_hash, lang, model, text) with perplexity for text.

    Each task reads its texts once and packs their words and pairs that are not
    hot, sorted, by ranges of their keys; a range meets the model's rows of it
    in one group.  The documents of one model are read at a time."""
    langs = shared_table(docs.select("lang", F.xxhash64("lang").alias("_lang")).distinct(), "langs")
    scored = []
    for m in range(MODELS):
        scored.append(shared_table(_sums_of_model(docs.where(F.col("model") == m), model, m), f"scored-{m}"))
        forget_shuffles(docs.sparkSession)  # the sums are written
    every = scored[0]
    for table in scored[1:]:
        every = every.unionByName(table)
    return every.join(broadcast_if_small(langs, BROADCAST_ROWS), "_lang").select(
        "doc_id", "text_hash", "lang", F.when(F.col("size") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("size"))).alias("perplexity"))


def _sums_of_model(docs: DataFrame, model: WordModel, m: int) -> DataFrame:
    """(doc_id, text_hash, _lang, size, bits) of ``docs`` by the ``m``-th model."""
    shared = docs.sparkSession.sparkContext.broadcast((model.spelling, model.unknown[m], model.keys, model.deltas[:, m]))
    rare = model.table.where(f"NOT hot AND delta{m} IS NOT NULL").select("key", F.col(f"delta{m}").cast("double").alias("delta"))
    buckets = max(1, -(-rare.count() // MET))
    doc_columns = ["doc_id", "text_hash", "_lang"]
    kinds = dict(docs.dtypes)
    doc_schema = f"doc_id {kinds['doc_id']}, text_hash long, _lang long"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        spelling, unknown, keys, deltas = shared.value
        bits, chunk = _bits(spelling), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, at, first, held = [t or "" for t in batch["text"].to_pylist()], 0, 0, []
            sums = np.zeros(len(texts))
            for some in pieces(texts):
                piece = WordPiece(some, bits)
                sums[at:at + len(some)] = np.bincount(piece.place, piece.spelled[piece.ids] + unknown, len(some))
                for place, key, n in _keyed(piece):
                    hot, delta = _looked_up(key, keys, deltas)
                    sums[at:at + len(some)] += np.bincount(place[hot], n[hot] * delta[hot], len(some))
                    held.append((place[~hot] + (at - first), key[~hot], n[~hot]))
                at += len(some)
                if at == len(texts) or sum(len(h[0]) for h in held) > PACKED:
                    yield rows(batch.slice(first, at - first), chunk, sums[first:at], texts[first:at], held)
                    chunk, first, held = chunk + 1, at, []

    def rows(batch: pa.RecordBatch, chunk: int, sums: np.ndarray, texts: list[str], held: list[tuple]) -> pa.RecordBatch:
        """The packed rows of a chunk of documents, and a row for each of them."""
        found = list(packed(*(np.concatenate(c) for c in zip(*held)), buckets))
        bucket, start, size, key, place, n = (list(c) for c in zip(*found)) if found else [[]] * 6
        none, nothing, docs_ = [None] * len(found), [None] * len(texts), len(texts)
        columns = [pa.array(bucket + [chunk % buckets] * docs_, pa.int32()), pa.array([chunk] * (len(found) + docs_), pa.int64()),
                   pa.array(start + nothing, pa.int64()), pa.array(size + nothing, pa.int64()),
                   *(pa.array(c + nothing, pa.binary()) for c in (key, place, n)),
                   pa.array(none + list(range(docs_)), pa.int64()), pa.array(none + sums.tolist(), pa.float64()),
                   pa.array(none + [len(t) for t in texts], pa.int64())]
        for c in doc_columns:
            columns.append(pa.concat_arrays([pa.nulls(len(found), batch[c].type), batch[c]]))
        return pa.record_batch(columns, ["bucket", "chunk", "first", "n_keys", "keys", "places", "counts", "place", "bits", "size", *doc_columns])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        key, delta = right["key"].to_numpy().view(np.uint64), right["delta"].to_numpy()
        order = np.argsort(key)
        key, delta = key[order].view(np.int64).view(np.uint64), delta[order]
        known = left.filter(pc.is_valid(left["place"])).select(["chunk", "place", "bits", "size", *doc_columns])
        chunks, places, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        met = left.filter(pc.is_valid(left["keys"])) if len(key) else left.slice(0, 0)
        for batch in met.to_batches(max_chunksize=16):
            for chunk, first, size, *raw in zip(*(batch[c].to_pylist() for c in ("chunk", "first", "n_keys", "keys", "places", "counts"))):
                steps, place, n = (from_planes(r, size) for r in raw)
                asked = np.uint64(first % (1 << 64)) + np.cumsum(steps, dtype=np.uint64)
                at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
                hit = np.flatnonzero(key[at] == asked)
                place = place[hit].astype(np.int64)
                total = np.bincount(place, n[hit] * delta[at[hit]])
                place = np.flatnonzero(np.bincount(place, minlength=1))
                chunks.append(np.full(len(place), chunk))
                places.append(place)
                sums.append(total[place])
        chunks, places, sums = (np.concatenate(c) for c in (chunks, places, sums))
        more = pa.table([pa.array(chunks), pa.array(places), pa.array(sums), pa.nulls(len(sums), pa.int64()),
                         *(pa.nulls(len(sums), known[c].type) for c in doc_columns)], names=known.column_names)
        return pa.concat_tables([known, more])
    asked = docs.select("doc_id", "text_hash", F.xxhash64("lang").alias("_lang"), "text").mapInArrow(
        pack, "bucket int, chunk long, first long, n_keys long, keys binary, places binary, counts binary, place long, "
              f"bits double, size long, {doc_schema}")
    model_rows = rare.select(key_bucket(buckets).alias("bucket"), "key", "delta")
    met = asked.groupBy("bucket").cogroup(model_rows.groupBy("bucket")).applyInArrow(
        meet, f"chunk long, place long, bits double, size long, {doc_schema}")
    return met.groupBy("chunk", "place").agg(F.sum("bits").alias("bits"), *[F.max(c).alias(c) for c in ("size", *doc_columns)]) \
        .select(*doc_columns, "size", "bits")


def _keyed(piece: WordPiece) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, key, n) of the words, then the pairs, of each text."""
    place, word, n = piece.counts(piece.place)
    yield place, piece.hashes[word].view(np.int64), n
    place, context, word, n = piece.pairs(piece.place)
    yield place, pair_keys(piece.hashes[context], piece.hashes[word]).view(np.int64), n


def _looked_up(key: np.ndarray, keys: np.ndarray, deltas: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a key is among ``keys``, its delta if so)."""
    if not len(keys):
        return np.zeros(len(key), bool), np.zeros(len(key))
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return keys[at] == key, np.nan_to_num(deltas[at].astype(np.float64))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) of the documents labelled good, without contradiction."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id") \
        .agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """Per document row: doc_id, text_hash, lang, perplexity, threshold, kept."""
    good = broadcast_if_small(shared_table(trusted_ids(labels), "trusted"), BROADCAST_ROWS)
    model = train_words(docs.select("doc_id", "text").join(good, "doc_id", "left_semi"))
    forget_shuffles(docs.sparkSession)  # the deltas are written
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "lang", text_half().alias("_half"), "text") \
        .join(good.withColumn("_good", F.lit(True)), "doc_id", "left") \
        .select("doc_id", "text_hash", "lang", F.when(F.col("_good") & F.col("_half").isNotNull(), 1 - F.col("_half"))
                .otherwise(ALL).cast("int").alias("model"), "text")
    scored = shared_table(word_perplexities(read, model), "perplexities")
    drop_tables(model.table)
    level = F.percentile_approx("perplexity", quantile, 10_000) * margin
    seen = scored.where("perplexity IS NOT NULL").join(good, "doc_id", "left_semi")
    by_lang = seen.groupBy("lang").agg(level.alias("own"))
    overall = seen.agg(level.alias("overall"))  # one row
    return scored.join(broadcast_if_small(by_lang, BROADCAST_ROWS).withColumnRenamed("lang", "_lang"),
                       F.col("lang").eqNullSafe(F.col("_lang")), "left") \
        .join(F.broadcast(overall)) \
        .select("doc_id", "text_hash", "lang", "perplexity", F.coalesce("own", "overall").alias("threshold")) \
        .withColumn("kept", F.col("perplexity").isNotNull()
                    & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (all its columns) without the rejected documents."""
    bad = broadcast_if_small(shared_table(classify(docs, labels).where("NOT kept").select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_text")).distinct(), "rejected"), BROADCAST_ROWS)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["bad_text"]), "left_anti")


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    from skylane.llm.common import read_table
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")) \
        .select("doc_id", "perplexity", "threshold", "kept")
