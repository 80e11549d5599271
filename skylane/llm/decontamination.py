"""Benchmark decontamination.

A window is ``window`` consecutive words of a benchmark item (an item of fewer
words, but not none, is one window).  Documents are scanned once: their words
are cut into disjoint blocks of about half a window, so every occurrence of a
window holds one whole block, and only the block hashes meet the hash set of
the benchmark's word n-grams (broadcast when its size is below a bound, else a
shuffle join).  Around each hit the windows themselves are compared word for
word, so no hash decides a result.

Defined results: NULL or word-free texts have no words and no hits; NULL
``doc_id`` is a document of its own kind; each repeated row gets its own
result row; very long texts are read whole, in time linear in their words and
hits; ties cannot occur (sets and sums only); benchmark rows with a NULL id or no words hold no window; an empty
benchmark hits nothing.  Only the named columns are read, so further columns
(also ones named like the results) do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skylane.llm.common import (broadcast_if_small, let, normalised_words, sha256_hex,
                                shared_table)

WINDOW = 13
#: Rows of windows or n-grams up to which the benchmark side is broadcast.
BROADCAST_ROWS = 500_000


def block_words(window: int) -> int:
    """Longest block such that any ``window`` words hold one whole block of a
    text cut into blocks of that many words."""
    return (window + 1) // 2


def word_blocks(norm: Column, size: int) -> Column:
    """The disjoint blocks of ``size`` words; words short of a block at the
    end are left out.  ``\\G`` ties each match to the end of the one before,
    so the scan is linear."""
    pattern = r"\G(%s[^ ]++)(?: |$)" % (r"(?:[^ ]++ ){%d}" % (size - 1) if size > 1 else "")
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(1))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows with their items: (gram, width, items)."""
    words = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").alias("item"),
        F.filter(F.split(normalised_words(F.col("text")), " "), lambda w: w != "").alias("words"))
    words = words.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(window)))
    starts = words.select("item", "words", "width", F.explode(
        F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("start"))
    grams = starts.select("item", "width", F.array_join(
        F.slice("words", F.col("start"), F.col("width")), " ").alias("gram"))
    return grams.groupBy("gram", "width").agg(F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit, items (distinct ids
    of items with an occurring window) and spans (merged [start, stop) word
    ranges inside occurring windows)."""
    windows = shared_table(benchmark_windows(benchmark, window), "benchmark-windows")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # <= window values
    source = docs.select("doc_id", "text")
    scanned = source.select("doc_id", F.xxhash64("text").alias("text_hash"),
                            normalised_words(F.col("text")).alias("norm"))
    sizes = sorted({block_words(w) for w in widths})
    scanned = shared_table(scanned.select(
        "doc_id", "text_hash",
        F.when(F.col("norm") == "", 0).otherwise(F.size(F.split("norm", " "))).alias("n_words"),
        *[F.transform(word_blocks(F.col("norm"), size), lambda b: F.xxhash64(b)).alias(f"blocks_{size}")
          for size in sizes]), "document-blocks")
    if not widths:
        return scanned.select("doc_id", "text_hash", "n_words", F.lit(0).alias("n_hit"),
                              F.expr("cast(array() as array<bigint>)").alias("items"),
                              F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans"))
    found = None
    for size in sizes:
        held = windows.where(F.col("width").isin([w for w in widths if block_words(w) == size]))
        parts = held.select(F.split("gram", " ").alias("words"), "width")
        grams = parts.select("words", F.explode(F.sequence(F.lit(1), F.col("width") - size + 1)).alias("at")) \
            .select(F.xxhash64(F.array_join(F.slice("words", F.col("at"), F.lit(size)), " ")).alias("block")) \
            .distinct()
        blocks = scanned.select("doc_id", "text_hash", F.posexplode(f"blocks_{size}").alias("at", "block"))
        hit = blocks.join(broadcast_if_small(grams, broadcast_rows), "block", "left_semi") \
            .select("doc_id", "text_hash", F.struct(F.lit(size).alias("size"), F.col("at")).alias("at"))
        found = hit if found is None else found.unionByName(hit)
    # a document's blocks are at most its words, however many documents share them
    found = shared_table(found.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("ats")),
                         "block-hits")
    checked = _verified(source, found, windows, widths, broadcast_rows)
    return scanned.select("doc_id", "text_hash", "n_words").alias("d").join(
        broadcast_if_small(checked, broadcast_rows).alias("h"),
        F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")),
        "left").select(
            "d.doc_id", "d.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast(checked.schema["items"].dataType)).alias("items"),
            F.coalesce("spans", F.array().cast(checked.schema["spans"].dataType)).alias("spans"))


def _verified(source: DataFrame, found: DataFrame, windows: DataFrame, widths: list[int],
              broadcast_rows: int) -> DataFrame:
    """The windows that occur around the block hits, one row per distinct
    (doc_id, text): n_hit, items, spans."""
    hits = broadcast_if_small(found, broadcast_rows).alias("f")
    texts = source.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).alias("s").join(
        hits, F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("s.text_hash") == F.col("f.text_hash"))) \
        .select("s.doc_id", "s.text_hash", "ats",
                F.split(normalised_words(F.col("text")), " ").alias("words"))

    def starts(at: Column, width: int, n: Column) -> Column:
        # the windows whose first whole block this is, so no two blocks list one
        size = block_words(width)
        first = F.greatest(F.lit(0), (at["at"] - 1) * size + 1)
        last = F.least(at["at"] * size, n - width)
        usable = (at["size"] == size) & (first <= last)
        return F.when(usable, F.transform(F.sequence(first, last), lambda s: F.struct(
            s.alias("start"), F.lit(width).alias("width")))) \
            .otherwise(F.expr("cast(array() as array<struct<start:int,width:int>>)"))

    def candidates(words: Column) -> Column:
        n = F.size(words)
        all_starts = F.flatten(F.flatten(F.transform(
            F.col("ats"), lambda at: F.array(*[starts(at, w, n) for w in widths]))))
        return F.transform(all_starts, lambda c: F.struct(
            c["start"].alias("start"), c["width"].alias("width"),
            F.array_join(F.slice(words, c["start"] + 1, c["width"]), " ").alias("gram")))

    tried = texts.select("doc_id", "text_hash", F.explode(let(F.col("words"), candidates)).alias("c")) \
        .select("doc_id", "text_hash", "c.start", "c.width", "c.gram")
    hit = shared_table(tried.join(broadcast_if_small(windows, broadcast_rows), ["gram", "width"]).select(
        "doc_id", "text_hash", "start", (F.col("start") + F.col("width")).alias("stop"), "items"), "window-hits")
    spans = merged_ranges(hit, ["doc_id", "text_hash"]).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.sum(F.col("stop") - F.col("start")).cast("int").alias("n_hit"))
    items = hit.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return spans.alias("s").join(items.alias("i"), F.col("s.doc_id").eqNullSafe(F.col("i.doc_id"))
                                 & (F.col("s.text_hash") == F.col("i.text_hash"))) \
        .select("s.doc_id", "s.text_hash", "items", "spans", "n_hit")


def merged_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, stop): the [start, stop) ranges of each key with
    overlapping and touching ones merged."""
    order = Window.partitionBy(*keys).orderBy("start")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    island = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranges.select(*keys, "start", "stop", opens.alias("_opens")) \
        .select(*keys, "start", "stop", island.alias("_island")) \
        .groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_island")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is inside an occurring window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents",
                  window: int = WINDOW) -> DataFrame:
    """``docs`` (all its columns) without contamination.  ``documents`` drops
    the contaminated documents; ``spans`` keeps every document and cuts the hit
    words out of ``text`` (what stands between words stays)."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode must be documents or spans, not {mode!r}")
    found = contamination(docs, benchmark, window).where("n_hit > 0")
    if mode == "documents":
        found = found.where(is_contaminated(F.col("n_hit"), F.col("n_words")))
    found = broadcast_if_small(shared_table(found.select(
        F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_text"), "spans").distinct(),
        "contaminated"), BROADCAST_ROWS)
    same = docs["doc_id"].eqNullSafe(found["_hit_id"]) & (F.xxhash64(docs["text"]) == found["_hit_text"])
    if mode == "documents":
        return docs.join(found, same, "left_anti")
    text = F.when(found["spans"].isNull(), docs["text"]).otherwise(without_words(docs["text"], found["spans"]))
    return docs.join(found, same, "left").select(
        *[text.alias("text") if c == "text" else docs[f"`{c}`"] for c in docs.columns])


def without_words(text: Column, spans: Column) -> Column:
    """``text`` without the words of the given word ranges."""
    word = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    pieces = F.regexp_extract_all(text, F.lit(rf"({word}|[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+)"), F.lit(1))

    def cut(pieces: Column) -> Column:
        first = F.when(pieces[0].rlike("^" + word), 0).otherwise(1)  # words and what stands between alternate

        def part(i: Column) -> Column:
            """What precedes span ``i`` and, from within it, all but the words."""
            span = F.try_element_at(spans, i + 1)
            start = F.when(i == 0, 0).otherwise(2 * F.try_element_at(spans, F.when(i == 0, 1).otherwise(i))["stop"] - 1 + first)
            stop = F.coalesce(2 * span["start"] + first, F.size(pieces))
            inside = F.filter(F.slice(pieces, stop + 1, F.greatest(F.lit(0), 2 * (span["stop"] - span["start"]) - 1)),
                              lambda p, j: j % 2 == 1)
            return F.concat(F.array_join(F.slice(pieces, start + 1, stop - start), ""),
                            F.coalesce(F.array_join(inside, ""), F.lit("")))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), part), "")
    return let(pieces, cut)


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contamination digest of every document against the whole benchmark."""
    from skylane.llm.common import read_table
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("n_words").cast("long"), F.col("n_hit").cast("long"),
        F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.array_join(ids, ",")).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


ORACLE_SQL = r"""
WITH b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
             FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT doc_id, item_id, s, dw.k AS k FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit
       FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM h)) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id
"""
