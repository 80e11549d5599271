"""Near-duplicate documents by a MinHash LSH forest.

A document's set is its distinct word shingles; documents are linked when the
sets' Jaccard similarity reaches the threshold, and the links' connected
components are the groups of copies.

1. Scan: each document's set gives ``TREES * DEPTH`` MinHash values and a
   128-bit hash of the whole set.  Documents of equal sets form a class; from
   here on a class is one row, so exact copies cost nothing further.
2. Forest: each tree sorts the classes by its own ``DEPTH`` values (a range
   partition, so a crowded region spreads over tasks).  The next ``NEXT`` rows
   in that order with a common prefix of at least ``MIN_PREFIX`` values are
   neighbours, unless one bit of each MinHash value rules a link out (more than
   five standard deviations below the threshold; a class carries these bits
   along as two numbers).  Each class is confirmed on the full sets against the
   smaller and the larger neighbour that most trees name; confirmed links give
   first components.
3. Regions (a tree's classes of one prefix) that are not one component yet are
   opened.  Up to ``NEAR`` classes meet whole, across components, unless their
   MinHash values rule a link out.  All classes of larger regions go through an
   exact prefix filter over the shingles that several components hold.  So the
   depth of comparison adapts to the region, and neither the place in a crowd
   nor the number of partitions decides what is found; a crowd of copies, one
   component already, costs nothing.

At the threshold 0.85 a pair shares a prefix in none of the 16 trees with
probability 8e-6; at 0.9 with 4e-8.

Defined results: a NULL text or a text without words has an empty set and no
links; a text of fewer words than a shingle is one shingle; a NULL ``doc_id``
takes no part in links (component NULL, kept); rows of one id are one document
(linked by any of its texts) and each gets a row; an empty table gives no rows.
Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from skylane.llm.common import broadcast_if_small, components, kept, shared_table

TREES, DEPTH = 16, 8
#: Values that a tree's rows must share to be a region, the next rows that the
#: first round compares, and the size up to which a region is compared whole.
MIN_PREFIX, NEXT, NEAR = 4, 2, 8
#: Members of a star that one task compares.
STAR = 2000
#: Numbers of 64 odd places of a set in a crowd.
WORDS = 8
BROADCAST_ROWS = 1_000_000

_U = np.uint64
_MULTIPLY = np.random.default_rng(20).integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * _U(2) + _U(1)
_ADD = np.random.default_rng(21).integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


class _WordHashes(dict):
    """Hash of each word, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII space only
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(kept("word-hashes", _WordHashes).__getitem__, words), _U, len(words))
    size = min(width, len(h))
    with np.errstate(over="ignore"):
        mixed = np.full(len(h) - size + 1, size, _U)
        for i in range(size):
            mixed = (mixed ^ h[i:len(h) - size + 1 + i]) * _U(0x9FB21C651E98DF25)
            mixed ^= mixed >> _U(29)
    return np.unique(mixed)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """TREES * DEPTH values (32 bits, big-endian) of each nonempty set."""
    out = np.empty((len(sets), TREES * DEPTH), ">u4")
    lo = 0
    while lo < len(sets):  # a cache-sized piece at a time
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 1 << 15):
            size += len(sets[hi])
            hi += 1
        values = np.concatenate(sets[lo:hi])
        begins = np.cumsum([0] + [len(s) for s in sets[lo:hi - 1]])
        for k in range(TREES * DEPTH):
            out[lo:hi, k] = np.minimum.reduceat((values * _MULTIPLY[k] + _ADD[k]) >> _U(32), begins)
        lo = hi
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, hash_a, hash_b, sig, bits_a, bits_b) per row; the
    hash of the set, its MinHash values and one bit of each; NULL for an empty
    set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch["text"]]
            full = [i for i, s in enumerate(sets) if len(s)]
            numbers, sigs = [(None,) * 4] * len(sets), [None] * len(sets)
            for i, row in zip(full, minhashes([sets[i] for i in full])):
                whole = xxhash.xxh3_128_digest(sets[i].tobytes()) + np.packbits((row & 1).astype(np.uint8)).tobytes()
                numbers[i] = tuple(int.from_bytes(whole[k:k + 8], "little", signed=True) for k in range(0, 32, 8))
                sigs[i] = row.tobytes()
            yield pa.record_batch([
                batch["doc_id"].cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                *(pa.array([x[k] for x in numbers], pa.int64()) for k in range(4)), pa.array(sigs, pa.binary())],
                ["doc_id", "n_shingles", "hash_a", "hash_b", "bits_a", "bits_b", "sig"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, hash_a long, hash_b long, bits_a long, bits_b long, sig binary")


def most_differing(threshold: int) -> int:
    """Most differing bits, of one bit per MinHash value, that do not rule a
    link out: at similarity s a bit agrees with probability (1 + s) / 2."""
    values, agree = TREES * DEPTH, (1 + threshold / 100) / 2
    return int(values * (1 - agree) + 5 * (values * agree * (1 - agree)) ** 0.5)


def forest(classes: DataFrame) -> DataFrame:
    """(tree, key, id, n, bits_a, bits_b): each class once per tree, with its
    values there."""
    return classes.select("id", "n", "sig", "bits_a", "bits_b", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")) \
        .select("tree", F.expr(f"substring(sig, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("key"), "id", "n",
                "bits_a", "bits_b")


def neighbours(trees: DataFrame, threshold: int) -> DataFrame:
    """(a, b, trees): the next rows in the trees' orders, a < b, with the number
    of times that a tree brings them together.  Ends of range partitions do not
    meet here; ``region_pairs`` and ``crowded_pairs`` do not depend on them."""
    differing = most_differing(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.frombuffer(b"".join(batch["key"].to_pylist()), ">u8").reshape(batch.num_rows, DEPTH // 2)
            rows = np.column_stack([batch["tree"].to_numpy().astype(np.int64), key[:, :MIN_PREFIX // 2].astype(np.uint64)
                                    .view(np.int64), *(batch[c].to_numpy() for c in ("id", "n", "bits_a", "bits_b"))])
            fresh = len(kept) if kept is not None else 0
            rows = np.concatenate([kept, rows]) if fresh else rows
            pairs = []
            for step in range(1, min(NEXT, len(rows) - 1) + 1):
                x, y = rows[:-step], rows[step:]
                near = (x[:, :-4] == y[:, :-4]).all(axis=1)
                near &= 100 * np.minimum(x[:, -3], y[:, -3]) >= threshold * np.maximum(x[:, -3], y[:, -3])
                near[:max(0, fresh - step)] = False  # met in the batch before
                x, y = x[near], y[near]
                near = np.bitwise_count((x[:, -2:] ^ y[:, -2:]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= differing
                pairs.append(np.sort(np.column_stack([x[near, -4], y[near, -4]]), axis=1))
            kept = rows[-NEXT:]
            found = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
    ordered = trees.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id")
    return ordered.mapInArrow(run, "a long, b long").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("trees"))


def best_pairs(pairs: DataFrame) -> DataFrame:
    """(a, b): each class with its best smaller and its best larger neighbour,
    so that a crowd of copies hangs together after one round."""
    smaller = pairs.groupBy("b").agg(F.max_by("a", F.struct("trees", -F.col("a"))).alias("a"))
    larger = pairs.groupBy("a").agg(F.max_by("b", F.struct("trees", -F.col("b"))).alias("b"))
    return smaller.select("a", "b").unionByName(larger.select("a", "b")).distinct()


def confirmed(docs: DataFrame, pairs: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    Each pair is a member b of the star of a; a large star is dealt into parts
    that each get a's text, so no task gets all of it."""
    pairs = shared_table(pairs.select("a", "b"), "pairs")
    if pairs.isEmpty():
        return pairs
    stars = shared_table(pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("parts")), "stars")
    members = pairs.join(broadcast_if_small(stars, BROADCAST_ROWS), "a").select(
        F.col("b").alias("id"), F.col("a").alias("star"), F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    centres = stars.select(F.col("a").alias("id"), F.col("a").alias("star"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    wanted = shared_table(members.unionByName(centres), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text") \
        .join(broadcast_if_small(wanted, BROADCAST_ROWS), "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), width).tobytes() for t in batch["text"]]
            yield pa.record_batch([batch["star"], batch["part"], batch["id"], pa.array(found, pa.binary())],
                                  ["star", "part", "id", "items"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, centre = None, None
        for batch in batches:
            found = []
            for *place, id_, items in zip(*(batch[c].to_pylist() for c in ("star", "part", "id", "items"))):
                items = np.frombuffer(items, _U)
                if place != star:  # the centre sorts first
                    star, centre = place, items
                if id_ != place[0]:
                    both = len(np.intersect1d(centre, items, assume_unique=True))
                    if 100 * both >= threshold * (len(centre) + len(items) - both):
                        found.append((place[0], id_))
            a, b = zip(*found) if found else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return shared_table(texts.mapInArrow(sets, "star long, part long, id long, items binary")
                        .repartition("star", "part")
                        .sortWithinPartitions("star", "part", (F.col("id") != F.col("star")))
                        .mapInArrow(compare, "a long, b long"), "confirmed")


def possible(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs that their MinHash values do not rule out."""
    values = TREES * DEPTH
    share = threshold / 100
    least = int(values * share - 5 * (values * share * (1 - share)) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, values) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))
    sig = classes.select("id", "sig")
    return pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a") \
        .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b") \
        .select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def open_regions(trees: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(region, id, component, ...) of all classes, and (region, size) of the
    regions (a tree's rows of one prefix) that are not one component."""
    rows = trees.join(broadcast_if_small(labels, BROADCAST_ROWS), "id", "left").select(
        "id", "n", "bits_a", "bits_b", F.coalesce("component", "id").alias("component"),
        F.xxhash64("tree", F.expr(f"substring(key, 1, {4 * MIN_PREFIX})")).alias("region"))
    mixed = rows.groupBy("region").agg(
        F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where(F.col("lo") != F.col("hi")).select("region", "size")
    return rows, shared_table(mixed, "regions")


def bits_agree(x, y, threshold: int):
    """Whether the bits of two classes (columns or structs) allow a link."""
    return F.bit_count(x("bits_a").bitwiseXOR(y("bits_a"))) + F.bit_count(x("bits_b").bitwiseXOR(y("bits_b"))) \
        <= most_differing(threshold)


def region_pairs(rows: DataFrame, mixed: DataFrame, threshold: int) -> DataFrame:
    """(a, b): the pairs across components in open regions of at most NEAR
    classes, but those whose sizes or bits rule a link out."""
    small = broadcast_if_small(mixed.where(F.col("size") <= NEAR).select("region"), BROADCAST_ROWS)
    members = rows.join(small, "region").groupBy("region").agg(  # at most NEAR
        F.collect_list(F.struct("id", "component", "n", "bits_a", "bits_b")).alias("members"))

    def linked(x, y):
        return ((x["id"] < y["id"]) & (x["component"] != y["component"])
                & bits_agree(x.getField, y.getField, threshold)
                & (100 * F.least(x["n"], y["n"]) >= threshold * F.greatest(x["n"], y["n"])))
    return members.select("members", F.explode("members").alias("x")) \
        .select(F.col("x.id").alias("a"), F.explode(F.filter("members", lambda y: linked(F.col("x"), y))).alias("y")) \
        .select("a", F.col("y.id").alias("b")).distinct()


def odd_places(token: str) -> dict[str, Column]:
    """Aggregates over a set's shingles: which of ``64 * WORDS`` places hold an
    odd number of them.  Sets differ in at least as many shingles as places."""
    word = F.pmod(F.shiftright(token, 6), F.lit(WORDS))
    return {f"odd{k}": F.bit_xor(F.when(word == k, F.expr(f"shiftleft(1L, CAST({token} & 63 AS INT))")).otherwise(0))
            for k in range(WORDS)}


def apart(x: str, y: str) -> Column:
    """The least number of shingles that only one of two sets holds."""
    out = F.col(f"{x}.alone") + F.col(f"{y}.alone")
    for k in range(WORDS):
        out = out + F.bit_count(F.col(f"{x}.odd{k}").bitwiseXOR(F.col(f"{y}.odd{k}")))
    return out


def crowd_prefixes(docs: DataFrame, crowd: DataFrame, labels: DataFrame, width: int, threshold: int) -> DataFrame:
    """The shingles by which classes of the crowd (id, bits_a, bits_b) may be
    linked across components: an exact prefix filter.

    Only shingles that stand in several components can be common to such a
    pair, and a set of n shingles has to share at least t * n: sets with fewer
    of them are out.  The others put theirs in one order, rarest first by exact
    counts; two linked sets share one of their first ``s - ceil(t * n) + 1``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text") \
        .join(broadcast_if_small(crowd.select("id"), BROADCAST_ROWS), "id", "left_semi")

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, texts = 0, batch["text"].to_pylist()
            while lo < len(texts):  # a bounded piece at a time
                sets, ids = [], []
                while lo < len(texts) and (not sets or sum(map(len, sets)) < 1 << 18):
                    sets.append(shingles(texts[lo], width))
                    ids.append(batch["id"][lo].as_py())
                    lo += 1
                sizes = [len(x) for x in sets]
                whole = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in sets]
                yield pa.record_batch([
                    pa.array(np.concatenate(sets).view(np.int64)), pa.array(np.repeat(np.array(ids, np.int64), sizes)),
                    pa.array(np.repeat(np.array(whole, np.int64), sizes)),
                    pa.array(np.repeat(np.array(sizes, np.int64), sizes))], ["token", "id", "whole", "n"])
    held = shared_table(texts.mapInArrow(items, "token long, id long, whole long, n long")
                        .dropDuplicates(["token", "id", "whole"])  # repeated rows of one id
                        .join(broadcast_if_small(labels, BROADCAST_ROWS), "id", "left")
                        .select("token", "id", "whole", "n", F.coalesce("component", "id").alias("component")), "crowd-items")
    tokens = held.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(
        F.sum("n").alias("holders"), F.count("*").alias("components")).where("components > 1").select("token", "holders")
    by_set = Window.partitionBy("id", "whole")
    needed = F.ceil(F.col("n") * threshold / F.lit(100.0) - 1e-9)
    rows = held.join(tokens, "token") \
        .withColumn("s", F.count("*").over(by_set)).where(F.col("s") >= needed) \
        .withColumns({c: x.over(by_set) for c, x in odd_places("token").items()}) \
        .withColumn("place", F.row_number().over(by_set.orderBy("holders", "token"))) \
        .where(F.col("place") <= F.col("s") - needed + 1) \
        .select("token", "id", "n", (F.col("s") - F.col("place") + 1).alias("left"), (F.col("n") - F.col("s")).alias("alone"),
                (F.sum("holders").over(by_set) / F.col("n")).alias("usual"), *odd_places("token"))
    return shared_table(rows.join(broadcast_if_small(crowd, BROADCAST_ROWS), "id"), "prefixes")


def may_link(threshold: int) -> Column:
    """Whether sets x and y of different components that share a shingle of
    their prefixes may be linked: there, both still have enough left.  Shingles
    that one component alone has, and places odd in one set alone, are in one
    of the two sets only, and a link allows few of those."""
    size = F.col("x.n") + F.col("y.n")
    return ((F.col("x.component") != F.col("y.component"))
            & (100 * F.least("x.n", "y.n") >= threshold * F.greatest("x.n", "y.n"))
            & ((100 + threshold) * F.least("x.left", "y.left") >= threshold * size)
            & ((100 + threshold) * apart("x", "y") <= (100 - threshold) * size)
            & bits_agree(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"), threshold))


def of_components(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(labels, BROADCAST_ROWS), "id", "left").withColumn("component", F.coalesce("component", "id"))


def pairs_of(x: DataFrame, y: DataFrame, threshold: int) -> DataFrame:
    return x.alias("x").join(y.alias("y"), (F.col("x.token") == F.col("y.token")) & may_link(threshold)) \
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def usual_pairs(rows: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """(a, b): of ``crowd_prefixes``, the sets of each shingle with the one there
    whose shingles most others hold.  Copies of one text are all near that one,
    so a crowd of them hangs together by a pair each."""
    rows = of_components(rows, labels)
    usual = rows.groupBy("token").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "token"]), F.struct("usual", "id")).alias("u"))
    return pairs_of(usual.select("token", "u.*"), rows, threshold)


def crowded_pairs(docs: DataFrame, crowd: DataFrame, labels: DataFrame, width: int, threshold: int,
                  rows: DataFrame | None = None) -> DataFrame:
    """(a, b): all pairs of the crowd that may be linked across components, by
    ``crowd_prefixes`` (``rows``, if made before, of the same or smaller
    components)."""
    rows = crowd_prefixes(docs, crowd, labels, width, threshold) if rows is None else rows
    rows = of_components(rows, labels)
    main = rows.groupBy("token", "component").agg(F.count("*").alias("size")).groupBy("token").agg(
        F.count("*").alias("components"), F.max_by("component", F.struct("size", "component")).alias("main")) \
        .where("components > 1").drop("components")
    rows = shared_table(rows.join(main, "token"), "mixed-prefixes")
    return pairs_of(rows.where("component <> main"), rows, threshold)


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (smallest linked id)
    and kept.  ``threshold`` is the similarity in hundredths."""
    signed = shared_table(signatures(docs, width), "signatures")
    known = signed.where("doc_id IS NOT NULL AND hash_a IS NOT NULL")
    classes = shared_table(known.groupBy("hash_a", "hash_b").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bits_a").alias("bits_a"),
        F.first("bits_b").alias("bits_b"), F.first("sig").alias("sig")), "classes")
    trees = forest(classes)
    # one id may stand for several texts, hence for several classes
    same_id = known.join(classes.select("hash_a", "hash_b", "id"), ["hash_a", "hash_b"]) \
        .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    near = shared_table(neighbours(trees, threshold), "neighbours")
    labels = components(confirmed(docs, best_pairs(near), width, threshold))
    rows, mixed = open_regions(trees, labels)
    rest = region_pairs(rows, mixed, threshold)
    large = mixed.where(F.col("size") > NEAR).select("region")
    if not large.isEmpty():  # these meet by the exact filter
        crowd = shared_table(rows.join(broadcast_if_small(large, BROADCAST_ROWS), "region", "left_semi")
                             .select("id", "bits_a", "bits_b").distinct(), "crowded")
        prefixes = crowd_prefixes(docs, crowd, labels, width, threshold)
        labels = components(confirmed(docs, usual_pairs(prefixes, labels, threshold), width, threshold), labels)
        rest = rest.unionByName(crowded_pairs(docs, crowd, labels, width, threshold, prefixes)).distinct()
    rest = shared_table(rest, "untried")
    if not rest.isEmpty():
        labels = components(confirmed(docs, possible(rest, classes, threshold), width, threshold), labels)
    labels = components(same_id.where("a <> b"), labels)
    return signed.join(labels, signed["doc_id"] == labels["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` (all its columns) with one document of each group of copies:
    the one of the smallest id; of rows with that id, the one of the smallest
    text (NULL last)."""
    found = near_duplicates(docs, width, threshold)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = broadcast_if_small(shared_table(gone, "copies"), BROADCAST_ROWS)
    left = docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    known = left.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min_by(row, F.struct(F.col("text").isNull(), "text")).alias("_row")).select("_row.*")
    return known.unionByName(left.where("doc_id IS NULL"))


def op5_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents: 3-word shingles, 0.85."""
    from skylane.llm.common import read_table
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=3, threshold=85)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT d.doc_id, count(s.shingle) AS n FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id),
g AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, g.c AS component_id, g.c = n.doc_id AS kept FROM n JOIN g ON g.id = n.doc_id
"""
