"""N-gram Jaccard join: a size-aware heavy-light join of word-shingle sets.

Two documents link when the Jaccard similarity of their sets of word shingles
reaches the threshold; the links' connected components are returned.  Every
link is found, or its ends are connected by others:

1. Scan: each text gives its set (64-bit hashes of shingles), the set's 128-bit
   hash and its first items in the order of the hashes.  Documents of equal
   sets form a class, one row from here on.
2. Small sets (fewer items than the boundary): all subsets of the sizes that a
   partner must share are enumerated, as the few items left out of the set's
   sum.  Sets that meet at a subset are linked by that alone, so the sets of a
   subset form a star, whatever their number.
3. Large sets scan inverted lists.  A set is posted under ``missing + k`` first
   items, where a partner lacks at most ``missing`` of the set's items and
   ``k`` is a tenth of it; two linked sets then meet in at least ``k`` lists.
   A set with fewer shared items there has no partner.  Lists of at most
   ``LIGHT`` sets are paired whole.  A partner met in heavier lists alone needs
   ``k`` of them: the few sets with so many are posted again, rarest items
   first by exact counts, under ``missing + 1`` items; in each list all are
   compared with the set of the rarest place, then those still in different
   components with each other.
4. Pairs that lengths, places and numbers of shared items cannot rule out are
   confirmed on the full sets.

The boundary has the least cost, measured on the table: subsets of the sets
below against places in the lists of those above.

Defined results: a NULL text or a text without words has an empty set and no
links; a text of fewer words than a shingle is one shingle; a NULL ``doc_id``
takes no part in links (component NULL); rows of one id are one document,
linked by any of its texts, and each gets a row; equal sets are linked; a very
long text is one set like any other, held whole by one task; an empty table
gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from skylane.llm.common import broadcast_if_small, components, join_counted, shared_table, text_pieces

LIGHT = 16
#: Small sets have fewer items than this at most, and leave at most four out.
SMALL_LIMIT = 40
BROADCAST_ROWS = 1_000_000

_U = np.uint64
_RANDOM = np.random.default_rng(31)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """The first powers of ``base`` modulo 2**64; a worker keeps up to 2**23."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        steps = np.full(max(size, 1 << 20), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 1 << 23:
            _powers[base] = have
    return have[:size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of all texts; ``offsets`` are the texts'
    ends in ``data``.  A word's hash is a polynomial of its bytes, from sums over
    all bytes; long words are hashed one by one."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~_SPACE[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_INVERSE, size), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers(_BASE, size)[starts]
    for i in np.flatnonzero(ends - starts > 64):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes().lower())
    hashes ^= (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
    hashes ^= hashes >> _U(32)
    hashes *= _U(0xA0761D6478BD642F)
    return starts, hashes ^ (hashes >> _U(29))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    starts, words = word_hashes(data, offsets - offsets[0])

    def shingles(first: int, n: int, size: int) -> np.ndarray:
        mixed = np.full(n, size, np.uint64)
        for k in range(size):
            mixed = (mixed ^ words[first + k:first + k + n]) * _U(0x9FB21C651E98DF25)
            mixed ^= mixed >> _U(29)
        return mixed
    at = np.searchsorted(starts, offsets - offsets[0])
    every = shingles(0, max(0, len(words) - width + 1), width)
    sets = []
    for first, n in zip(at[:-1].tolist(), np.diff(at).tolist()):
        found = np.sort(every[first:first + n - width + 1] if n >= width else shingles(first, min(n, 1), n))
        sets.append(found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found)
    return sets


def lists(arrays: list[np.ndarray]) -> pa.Array:
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.LargeListArray.from_arrays(np.cumsum([0] + [len(a) for a in arrays]), pa.array(values.view(np.int64))) \
        .cast(pa.list_(pa.int64()))


class Threshold:
    """The bounds that a similarity of ``hundredths`` sets on set sizes, overlap
    and lists."""

    def __init__(self, hundredths: int):
        self.t = hundredths

    def least(self, n):
        """Smallest size of a partner, and smallest overlap with one."""
        return (self.t * n + 99) // 100

    def overlap(self, n, m):
        return (self.t * (n + m) + 99 + self.t) // (100 + self.t)

    def met(self, n):
        """Lists in which two linked sets of this size, or the larger, meet."""
        return (n + 9) // 10

    def posted(self, n: int) -> int:
        return min(n, n - self.least(n) + self.met(n))

    def column(self, bound: str, *sizes: Column) -> Column:
        """The same bounds as columns."""
        if bound == "least":
            return F.floor((self.t * sizes[0] + 99) / 100)
        if bound == "posted":
            return F.least(sizes[0], sizes[0] - self.column("least", *sizes) + self.column("met", *sizes))
        if bound == "met":
            return F.floor((sizes[0] + 9) / 10)
        return F.floor((self.t * (sizes[0] + sizes[1]) + 99 + self.t) / (100 + self.t))

    def partners(self, n: int) -> range:
        return range(max(1, self.least(n)), 100 * n // self.t + 1)

    def subsets(self, n: int) -> int:
        """Number of subsets under which a small set is listed."""
        return sum(comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= n)


def scan(docs: DataFrame, width: int, threshold: Threshold) -> DataFrame:
    """(doc_id, n, hash_a, hash_b, items) per row: the set's size, hash (NULL if
    empty) and first items, or all of a set that may be small."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_pieces(batch["text"]):
                sets = shingle_sets(texts, width)
                whole = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.record_batch([
                    batch["doc_id"].slice(at, len(sets)).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array([w and int.from_bytes(w[k:k + 8], "little", signed=True) for w in whole], pa.int64()) for k in (0, 8)),
                    lists([s if len(s) < SMALL_LIMIT else s[:threshold.posted(len(s))] for s in sets])], ["doc_id", "n", "hash_a", "hash_b", "items"])
                at += len(sets)
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, hash_a long, hash_b long, items array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, n, items): the whole sets of the classes ``wanted`` (cls, id,
    hash_a, hash_b), read again from the texts of their ids."""
    few = broadcast_if_small(wanted.select(F.col("cls"), F.col("id"), F.col("hash_a"), F.col("hash_b")), BROADCAST_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(few, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_pieces(batch["text"]):
                sets = shingle_sets(texts, width)
                named = [batch[c].slice(at, len(sets)).to_pylist() for c in ("cls", "hash_a", "hash_b")]
                at += len(sets)
                rows = [(c, s) for c, a, b, s in zip(*named, sets)
                        if xxhash.xxh3_128_digest(s.tobytes()) == a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True)]
                yield pa.record_batch([pa.array([c for c, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()),
                                       lists([s for _, s in rows])], ["cls", "n", "items"])
    found = texts.select("cls", "hash_a", "hash_b", "text").mapInArrow(run, "cls long, n long, items array<long>")
    return found.groupBy("cls").agg(F.first("n").alias("n"), F.first("items").alias("items"))  # a row may be repeated


def common_items(small: DataFrame, threshold: Threshold) -> DataFrame:
    """(cls, n, items) of the sets of ``small`` (cls, items whole) that others
    may be linked with: n items, of which ``items`` stand in several sets."""
    rows = small.select("cls", F.size("items").cast("long").alias("n"), F.explode("items").alias("token"))
    several = rows.groupBy("token").agg(F.count("*").alias("size")).where("size > 1").select("token")
    return rows.join(several, "token").groupBy("cls", "n").agg(F.collect_list("token").alias("items")) \
        .where(F.size("items") >= threshold.column("least", F.col("n")))  # one set's items


def subset_links(small: DataFrame, threshold: Threshold, boundary: int) -> DataFrame:
    """(a, b): links between the sets of ``small`` (cls, items whole), each of a
    subset's sets with one of the smaller size there.  Items of one set alone
    are in no common subset, so they are among those left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[np.ndarray] = []
            for cls, n, items in zip(*(batch[c].to_pylist() for c in ("cls", "n", "items"))):
                x = np.array(items, np.int64).view(np.uint64)
                mixed = np.stack([x * _U(_BASE) ^ (x >> _U(31)), (x ^ _U(0xD6E8FEB86659FD93)) * _U(0xA0761D6478BD642F)], axis=1)
                mixed = (mixed ^ (mixed >> _U(29))) * _U(0x9FB21C651E98DF25)
                left_out = [mixed.sum(axis=0, dtype=np.uint64)[None, :]]  # by number of items left out
                last = [np.full(1, -1)]
                for m in threshold.partners(n):
                    out = len(x) - threshold.overlap(n, m)
                    if m >= boundary or out < 0:
                        continue
                    while len(left_out) <= out:  # leave out one more, behind the last one
                        each = np.arange(len(x))
                        sum_, item = np.nonzero(last[-1][:, None] < each[None, :])
                        left_out.append(left_out[-1][sum_] - mixed[item])
                        last.append(item)
                    sums = left_out[out].view(np.int64)
                    rows.append(np.column_stack([np.broadcast_to([min(m, n), max(m, n), cls, n], (len(sums), 4)), sums]))
            found = np.concatenate(rows) if rows else np.zeros((0, 6), np.int64)
            yield pa.record_batch([pa.array(found[:, k]) for k in range(6)], ["lo", "hi", "cls", "n", "sum_a", "sum_b"])
    keys = ["lo", "hi", "sum_a", "sum_b"]
    found = common_items(small, threshold).mapInArrow(run, "lo long, hi long, cls long, n long, sum_a long, sum_b long")
    found = shared_table(found, "subsets")
    stars = found.groupBy(*keys).agg(F.min(F.when(F.col("n") == F.col("lo"), F.col("cls"))).alias("a"), F.count("*").alias("size")) \
        .where("size > 1 AND a IS NOT NULL").drop("size")
    return found.join(stars, keys).where("cls <> a").select("a", F.col("cls").alias("b")).distinct()


def light_pairs(rows: DataFrame, threshold: Threshold, boundary: int) -> DataFrame:
    """(a, b, met): pairs of sets that meet in lists of at most LIGHT sets, that
    may be linked.  ``rows``: token, cls, n, pos, rank (of the place among the
    set's shared ones), heavy (places of the set in heavier lists)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.column_stack([batch[c].to_numpy() for c in ("token", "cls", "n", "pos", "heavy", "rank")]).astype(np.int64)
            fresh = len(kept) if kept is not None else 0
            own = np.concatenate([kept, own]) if fresh else own
            pairs = []
            for step in range(1, min(LIGHT, len(own) - 1) + 1):
                near = own[:-step, 0] == own[step:, 0]
                near[:max(0, fresh - step)] = False  # met in the batch before
                x, y = own[:-step][near], own[step:][near]
                (n, p), (m, q) = x[:, 2:4].T, y[:, 2:4].T
                left = np.minimum(x[:, 5], y[:, 5]) + 1 + np.minimum(n - p - 1, m - q - 1)
                near = (np.maximum(n, m) >= boundary) & (np.minimum(n, m) >= threshold.least(np.maximum(n, m))) \
                    & (left >= threshold.overlap(n, m)) & (x[:, 1] != y[:, 1])
                pairs.append(np.column_stack([x[near], y[near]]))
            kept = own[-LIGHT:]
            found = np.concatenate(pairs) if pairs else np.zeros((0, 12), np.int64)
            swap = found[:, 1] > found[:, 7]
            found[swap] = np.roll(found[swap], 6, axis=1)
            yield pa.record_batch([pa.array(found[:, k]) for k in (1, 7, 2, 8, 3, 9)] + [pa.array(np.minimum(found[:, 4], found[:, 10]))],
                                  ["a", "b", "n", "m", "p", "q", "heavy"])
    ordered = rows.repartition("token").sortWithinPartitions("token", "cls")
    n, m = F.col("n"), F.col("m")
    return ordered.mapInArrow(run, "a long, b long, n long, m long, p long, q long, heavy long") \
        .groupBy("a", "b", "n", "m", "heavy").agg(F.count("*").alias("met"), F.max("p").alias("p"), F.max("q").alias("q")) \
        .where(F.col("met") + F.col("heavy") + F.least(n - F.col("p") - 1, m - F.col("q") - 1) >= threshold.column("overlap", n, m)) \
        .select("a", "b", "met")


def rarest_first(sets: DataFrame, threshold: Threshold) -> DataFrame:
    """(token, cls, n, pos, rank): postings of whole sets, rarest items first by
    exact counts, under as many as linked sets need to meet once; rank among
    the set's items that others have too."""
    rows = sets.select("cls", "n", F.explode("items").alias("token"))
    counts = rows.groupBy("token").agg(F.count("*").alias("df"))
    ordered = rows.join(counts, "token").groupBy("cls", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("items"))  # one set's items
    first = F.slice("items", F.lit(1), (F.col("n") - threshold.column("least", F.col("n")) + 1).cast("int"))
    placed = F.filter(F.transform(first, lambda x, i: F.struct(x["df"].alias("df"), x["token"].alias("token"), i.cast("long").alias("pos"))),
                      lambda x: x["df"] > 1)
    return ordered.select("cls", "n", F.posexplode(placed).alias("rank", "item")) \
        .select(F.col("item.token").alias("token"), "cls", "n", F.col("item.pos").alias("pos"), F.col("rank").cast("long").alias("rank"))


def may_link(x: str, y: str, threshold: Threshold) -> Column:
    """Whether sets that share the item at these places may be linked: before
    it, only items that others have too can be shared."""
    n, m, p, q = (F.col(c) for c in (f"{x}.n", f"{y}.n", f"{x}.pos", f"{y}.pos"))
    return F.least(f"{x}.rank", f"{y}.rank") + 1 + F.least(n - p - 1, m - q - 1) >= threshold.column("overlap", n, m)


def central_pairs(posted: DataFrame, threshold: Threshold) -> DataFrame:
    """(a, b, met): the sets of each list with the one of its rarest place."""
    centre = posted.groupBy("token").agg(F.min(F.struct("pos", "cls", "n", "rank")).alias("c")).select("token", "c.*").alias("x")
    y = posted.alias("y")
    return y.join(centre, (F.col("x.token") == F.col("y.token")) & (F.col("x.cls") != F.col("y.cls")) & may_link("x", "y", threshold)) \
        .groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).agg(F.count("*").alias("met"))


def separate_pairs(posted: DataFrame, labels: DataFrame, threshold: Threshold) -> DataFrame:
    """(a, b): the pairs in the lists whose ends are in different components."""
    named = posted.join(broadcast_if_small(labels.withColumnRenamed("id", "cls"), BROADCAST_ROWS), "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    mixed = named.groupBy("token", "component").agg(F.count("*").alias("size")).groupBy("token").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("size", "component")).alias("main")).where("parts > 1").drop("parts")
    rows = shared_table(named.join(mixed, "token"), "mixed-lists")
    x, y = rows.where("component <> main").alias("x"), rows.alias("y")
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component")) & may_link("x", "y", threshold)) \
        .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()


def confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""
    pairs = shared_table(pairs.select("a", "b"), "pairs")
    if pairs.isEmpty():
        return pairs
    ends = shared_table(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "ends")
    sets = shared_table(full_sets(docs, classes.join(broadcast_if_small(ends, BROADCAST_ROWS), "cls", "left_semi"), width), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch["x"], batch["y"]
            linked = []
            for i in range(batch.num_rows):
                own, other = (np.asarray(side[i].values) for side in (x, y))
                both = len(np.intersect1d(own, other, assume_unique=True))
                linked.append(100 * both >= threshold.t * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return shared_table(pairs.join(sets.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
                        .join(sets.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a")
                        .select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "confirmed")


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    few = broadcast_if_small(labels, BROADCAST_ROWS)
    for side in ("a", "b"):
        pairs = pairs.join(few.select(F.col("id").alias(side), F.col("component").alias(f"of_{side}")), side, "left")
    return pairs.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def boundary_of(classes: DataFrame, posted: DataFrame, threshold: Threshold) -> int:
    """The size from which scanning lists costs less than enumerating subsets:
    rows that either way makes, by size of set (at most SMALL_LIMIT rows are
    collected)."""
    sizes = {r["n"]: r["sets"] for r in classes.where(F.col("n") < SMALL_LIMIT).groupBy("n").agg(F.count("*").alias("sets")).collect()}
    scans = {r["n"]: r["rows"] for r in posted.where(F.col("n") < SMALL_LIMIT).groupBy("n").agg(F.sum("size").alias("rows")).collect()}
    cost = best = 0
    boundary = 1
    for n in range(1, SMALL_LIMIT):
        lists_of_n = sizes.get(n, 0) * threshold.posted(n) + scans.get(n, 0)
        cost += sizes.get(n, 0) * threshold.subsets(n) - lists_of_n
        if cost <= best:
            best, boundary = cost, n + 1
    return boundary


def jaccard_components(docs: DataFrame, width: int = 5, hundredths: int = 80) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (the smallest id that
    links reach).  ``hundredths`` is the least similarity of a link."""
    threshold = Threshold(hundredths)
    scanned = shared_table(scan(docs, width, threshold).withColumn("row", F.monotonically_increasing_id()), "sets")
    known = scanned.where("doc_id IS NOT NULL AND hash_a IS NOT NULL")
    classes = shared_table(known.groupBy("hash_a", "hash_b").agg(
        F.min(F.struct("doc_id", "row")).alias("first"), F.first("n").alias("n"), F.count("*").alias("copies"))
        .select(F.col("first.row").alias("cls"), F.col("first.doc_id").alias("id"), "n", "hash_a", "hash_b", "copies"), "classes")
    # only a class's first row is posted
    firsts = scanned.join(broadcast_if_small(classes.select(F.col("cls").alias("row")), BROADCAST_ROWS), "row", "left_semi")
    places = firsts.select(F.col("row").alias("cls"), "n", F.posexplode(F.slice(
        "items", F.lit(1), threshold.column("posted", F.col("n")).cast("int"))).alias("pos", "token"))
    sizes = places.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    posted = shared_table(places.join(sizes, "token").select("token", "cls", "n", F.col("pos").cast("long").alias("pos"), "size"), "places")

    boundary = boundary_of(classes, posted, threshold)
    small = firsts.where(F.col("n") < boundary).select(F.col("row").alias("cls"), "items")
    links = subset_links(small, threshold, boundary) if boundary > 1 else None
    posted = posted.where(F.col("n") >= threshold.least(boundary))
    heavy = F.col("size") > LIGHT
    least_met = threshold.column("met", threshold.column("least", F.col("n")))
    alive = shared_table(posted.groupBy("cls", "n").agg(
        F.count("*").alias("shared"), F.count(F.when(heavy, 1)).alias("heavy"))
        .where(F.col("shared") >= least_met).select("cls", "heavy", (F.col("heavy") >= least_met).alias("again")), "alive")
    of_set = Window.partitionBy("cls").orderBy("pos")  # at most a fifth of one set's items
    ranked = posted.join(broadcast_if_small(alive.select("cls", "heavy"), BROADCAST_ROWS), "cls") \
        .withColumn("rank", F.row_number().over(of_set) - 1)
    pairs = light_pairs(ranked.where(~heavy), threshold, boundary)
    again = classes.join(broadcast_if_small(alive.where("again").select("cls"), BROADCAST_ROWS), "cls", "left_semi")
    dense = shared_table(rarest_first(full_sets(docs, again, width), threshold), "rarest-first")
    pairs = shared_table(pairs.unionByName(central_pairs(dense, threshold)), "met")

    # each set first with the partner it meets most, then what is still apart
    labels = components(shared_table(links, "subset-links")) if links is not None else None
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("met", -F.col("a"))).alias("a"))
    labels = components(confirmed(docs, best, classes, width, threshold), labels)
    labels = components(confirmed(docs, across(pairs.select("a", "b"), labels).distinct(), classes, width, threshold), labels)
    apart = across(separate_pairs(dense, labels, threshold), labels)
    labels = components(confirmed(docs, apart, classes, width, threshold), labels)

    named = join_counted(scanned.select("doc_id", "n", "hash_a", "hash_b"),
                         classes.select("hash_a", "hash_b", "cls", "id", "copies"), ["hash_a", "hash_b"], "copies")
    named = shared_table(named.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("cls")).alias("cls"), "id"), "named")
    # one id may stand for several texts, hence for several classes
    several = named.where("cls IS NOT NULL").groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("last")).where("a < last")
    labels = components(named.join(broadcast_if_small(several, BROADCAST_ROWS), "doc_id").where("cls <> a")
                        .select("a", F.col("cls").alias("b")).distinct(), labels)
    labels = labels.unionByName(labels.select(F.col("component").alias("id"), "component").distinct())
    linked = labels.join(classes.select(F.col("cls").alias("id"), F.col("id").alias("doc")), "id")
    smallest = linked.groupBy("component").agg(F.min("doc").alias("component_id"))
    of_class = shared_table(linked.join(smallest, "component").select(F.col("id").alias("cls"), "component_id"), "components")
    return named.join(broadcast_if_small(of_class, BROADCAST_ROWS), "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "id", "doc_id")).alias("component_id"))


def op11_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Linked documents: 3-word shingles, similarity 0.9."""
    from skylane.llm.common import read_table
    return jaccard_components(read_table(spark, sf_dir, "documents"), width=3, hundredths=90)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT d.doc_id, count(s.shingle) AS n FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * both >= 90 * (na.n + nb.n - both)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id),
g AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, g.c AS component_id FROM n JOIN g ON g.id = n.doc_id
"""
