"""Removal of repeated passages (suffix-array style).

A byte is removed if a string of ``match`` bytes that covers it also starts
earlier (in a document of smaller id, or earlier in the same document).

Sorting the suffixes of every byte would move many times the corpus, so the
suffixes are sampled by content: of each string of ``match`` bytes only the
suffix at its anchor is kept, the position whose leading ``LEAD`` bytes hash
smallest.  Equal strings have the same anchor, so no repeat is missed.

1. Scan: the hashes of the anchors' leading bytes are counted; those that
   occur once cannot repeat.  The others set bits in a bitmap of bounded size
   (a false bit only costs work).
2. Scan: each anchor in the bitmap becomes a row with a hash of its context,
   the at most 168 bytes of the strings that share the anchor.  All but the
   earliest of equal contexts repeat as a whole.  Within a batch they are left
   out before the shuffle, so a passage that a third of all documents share
   crosses it once per batch.
3. Scan: leading bytes with several contexts are the ends of repeats.  Only
   their anchors come with the context's text.  These suffixes are
   range-partitioned by leading bytes (Spark samples the splitters); equal
   leading bytes never part, so no match crosses a boundary.  Each bucket is
   sorted by several keys (leading 8 bytes, leading 32 bytes, the whole string;
   the last two as 64-bit hashes) and neighbours are compared: all but the
   first of equal strings are repeats.
4. The repeats of a document are merged into spans and cut out.

Defined results: a NULL text is empty; a NULL ``doc_id`` counts as the
smallest id; rows with the same id and text are one document, and each gets
its result; of one id with several texts the order is by a hash of the text;
an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skylane.llm.common import give_back, kept, shared_table

MATCH = 100
LEAD = 32
#: Positions handled at once (a dozen arrays of 2 MB), and the largest bitmap
#: (2**28 bits: 32 MB).
SEGMENT = 1 << 18
MAX_BITS = 28
CARRIED = 50_000
NO_ID = -(1 << 63)

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64; the tables of
    the worker's earlier operator go."""
    n = SEGMENT + 4 * MATCH

    def build() -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)
    return kept(f"suffix-powers-{n}", build)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all beginnings."""
    up, _ = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    sums[1:] = data
    sums[1:] += np.uint64(1)
    sums[1:] *= up[:len(data)]
    np.cumsum(sums, out=sums)
    return sums


def string_hashes(sums: np.ndarray, first, last) -> np.ndarray:
    """A 64-bit hash of the bytes [first, last), from the beginnings' hashes."""
    _, down = _powers()
    h = (sums[last] - sums[first]) * down[first]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def rolling_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """The hash of each ``width`` consecutive bytes."""
    return string_hashes(sums, slice(0, len(sums) - width), slice(width, None))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def anchor_runs(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For texts that end at ``ends`` in ``data``: (anchor, first, stop, lead,
    whole) of each run of strings with the same anchor: together they are the
    bytes [first, stop); lead and whole are the hashes of the anchor's leading
    bytes and of the context with the anchor's place in it."""
    n = len(data)
    for base in range(0, max(0, n - MATCH + 1), SEGMENT):
        part = data[base:base + SEGMENT + MATCH - 1]
        sums = prefix_sums(part)
        leads = rolling_hashes(sums, LEAD)
        order = (leads >> np.uint64(32) << np.uint64(32)) | np.arange(len(leads), dtype=np.uint64)
        anchor = (sliding_min(order, MATCH - LEAD + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(base, base + len(anchor))
        inside = ends[np.searchsorted(ends, starts, side="right")] - starts >= MATCH
        cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])) + 1
        first = np.concatenate(([0], cut))
        last = np.concatenate((cut, [len(anchor)])) - 1
        keep = inside[first]
        first, stop = first[keep], last[keep] + MATCH
        at = anchor[first]
        whole = string_hashes(sums, first, stop) ^ ((at - first).astype(np.uint64) * _MIX)
        yield at + base, first + base, stop + base, leads[at], whole


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, memoryview]:
    """Bytes and end offsets of a binary column, without NULLs; nothing is copied."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets[1:] - offsets[0], memoryview(raw)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64("text").alias("version"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _each(batches: Iterator[pa.RecordBatch], of_batch) -> Iterator[pa.RecordBatch]:
    """What ``of_batch`` makes of each batch; nothing of a batch stays in the
    worker while it waits for the next one."""
    for batch in batches:
        yield from of_batch(batch)
        del batch
        give_back()


def repeated_leads(source: DataFrame) -> DataFrame:
    """(lead): hashes of leading bytes that more than one anchor has."""
    def counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, ends, _ = _texts(batch["text"])
        found = [leads for _, _, _, leads, _ in anchor_runs(data, ends)]
        leads, counts = np.unique(np.concatenate(found), return_counts=True) if found else (
            np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield pa.record_batch([pa.array(leads.view(np.int64)), pa.array(np.minimum(counts, 2).astype(np.int8))],
                              ["lead", "n"])
    return source.select("text").mapInArrow(lambda batches: _each(batches, counted), "lead long, n byte") \
        .groupBy("lead").agg(F.sum("n").alias("n")).where("n > 1").select("lead")


def lead_bitmap(leads: DataFrame) -> tuple[np.ndarray, int]:
    """Bitmap over the first bits of the hashes, at most 2**MAX_BITS bits."""
    bits = int(min(MAX_BITS, max(16, leads.count().bit_length() + 6)))
    place = F.shiftrightunsigned("lead", 64 - bits)
    words = leads.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(lead, %d) & 63 as int))" % (64 - bits))).alias("held"))
    table = words.toArrow()  # at most 2**(MAX_BITS - 6) rows
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[table["word"].to_numpy()] = table["held"].to_numpy().view(np.uint64)
    return bitmap, bits


class _Hits:
    """The anchors of a batch that are in a bitmap, oldest document first, as
    arrays; ``again`` marks contexts that an earlier row of the batch has (rows
    of the same place, from repeated documents, are left out)."""

    def __init__(self, batch: pa.RecordBatch, held: np.ndarray, bits: int):
        doc, version = batch["doc"].to_numpy(), batch["version"].to_numpy()
        by_age = np.lexsort((version, doc))
        doc, version = doc[by_age], version[by_age]
        data, ends, self.raw = _texts(batch["text"].take(pa.array(by_age)))
        shift, six, low = np.uint64(64 - bits), np.uint64(6), np.uint64(63)
        parts = []
        for run in anchor_runs(data, ends):
            place = run[3] >> shift
            hit = np.flatnonzero((held[place >> six] >> (place & low)) & np.uint64(1))
            parts.append([column[hit] for column in run])
        if not parts:
            parts = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2]
        self.at, self.first, self.stop, self.lead, self.whole = (np.concatenate(c) for c in zip(*parts))
        owner = np.searchsorted(ends, self.first, side="right")
        self.doc, self.version = doc[owner], version[owner]
        self.start = self.first - np.concatenate(([0], ends[:-1]))[owner]
        _, earliest, which = np.unique(self.whole, return_index=True, return_inverse=True)
        earliest = earliest[which]
        self.again = earliest != np.arange(len(earliest))
        same = self.again & (self.doc[earliest] == self.doc) & (self.version[earliest] == self.version) \
            & (self.start[earliest] == self.start)
        self.new, self.again = ~self.again, self.again & ~same

    def repeats(self) -> tuple[np.ndarray, ...]:
        """(doc, version, start, stop) of the contexts met again, merged."""
        doc, version, start = (x[self.again] for x in (self.doc, self.version, self.start))
        stop = start + (self.stop - self.first)[self.again]
        if not len(doc):
            return doc, version, start, stop
        opens = np.concatenate(([True], (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])
                                | (start[1:] > stop[:-1]) | (start[1:] < start[:-1])))
        begin = np.flatnonzero(opens)
        return doc[begin], version[begin], start[begin], np.maximum.reduceat(stop, begin)


def _spans(columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc", "version", "start", "stop"])


def whole_repeats(source: DataFrame, bitmap: np.ndarray, bits: int) -> DataFrame:
    """Rows (lead, several, again, doc, version, start, stop): ``again`` marks
    contexts that an earlier row has as a whole, ``several`` leading bytes with
    different contexts; rows that are neither are left out.  Repeats within
    one batch have no lead."""
    shared = source.sparkSession.sparkContext.broadcast(bitmap)

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = ["lead", "whole", "doc", "version", "start", "stop"]
        hits = _Hits(batch, shared.value, bits)
        new = hits.new
        yield pa.record_batch([pa.array(c) for c in (
            hits.lead[new].view(np.int64), hits.whole[new].view(np.int64), hits.doc[new], hits.version[new],
            hits.start[new], hits.start[new] + (hits.stop - hits.first)[new])], names)
        repeats = hits.repeats()
        none = pa.nulls(len(repeats[0]), pa.int64())
        yield pa.record_batch([pa.array(repeats[0]), none, *(pa.array(c) for c in repeats)], names)
    # repeats within a batch carry their document's id as lead, to be spread
    rows = source.mapInArrow(lambda batches: _each(batches, found),
                             "lead long, whole long, doc long, version long, start long, stop long") \
        .repartition("lead")
    by_lead, by_whole = Window.partitionBy("lead"), Window.partitionBy("lead", "whole")
    age = F.struct("doc", "version", "start")
    known = F.col("whole").isNotNull()
    return rows.select(
        F.when(known, F.col("lead")).alias("lead"),
        (known & (F.min("whole").over(by_lead) != F.max("whole").over(by_lead))).alias("several"),
        (~known | (F.min(F.when(known, age)).over(by_whole) < age)).alias("again"),
        "doc", "version", "start", "stop").where("several OR again")


_ROW = "key long, lead long, at int, context binary, doc long, version long, start long"


def anchored_suffixes(source: DataFrame, bitmap: np.ndarray, bits: int) -> DataFrame:
    """Rows of the anchors in the bitmap with their contexts, each context once
    per batch (the others are known as repeats)."""
    shared = source.sparkSession.sparkContext.broadcast(bitmap)

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ROW.split(", ")]
        hits = _Hits(batch, shared.value, bits)
        new, raw = hits.new, hits.raw
        at, first, stop = hits.at[new], hits.first[new], hits.stop[new]
        yield pa.record_batch([
            pa.array([int.from_bytes(raw[a:a + 8], "big") - (1 << 63) for a in at.tolist()], pa.int64()),
            pa.array(hits.lead[new].view(np.int64)), pa.array((at - first).astype(np.int32)),
            # bytes: Arrow does not let go of the views that it reads
            pa.array([bytes(raw[f:e]) for f, e in zip(first.tolist(), stop.tolist())], pa.binary()),
            pa.array(hits.doc[new]), pa.array(hits.version[new]), pa.array(hits.start[new])], names)
    return source.mapInArrow(lambda batches: _each(batches, found), _ROW)


def _bucket(rows: pa.Table) -> Iterator[tuple[int, int, int, int]]:
    """(doc, version, start, stop) of the repeats among rows of whole leads."""
    doc, version, start = (rows[c].to_numpy() for c in ("doc", "version", "start"))
    by_age = np.lexsort((start, version, doc))
    rows = rows.take(pa.array(by_age))
    doc, version, start = doc[by_age], version[by_age], start[by_age]
    same = (doc[1:] == doc[:-1]) & (version[1:] == version[:-1])
    document = np.concatenate(([0], np.cumsum(~same)))
    contexts = rows["context"].to_pylist()
    leads = rows["lead"].to_numpy()
    row = 0
    hashes, owners, places = [], [], []
    while row < len(contexts):  # as many contexts as fit a segment
        stop, size = row, 0
        while stop < len(contexts) and (stop == row or size + len(contexts[stop]) <= SEGMENT):
            size += len(contexts[stop])
            stop += 1
        lengths = np.array([len(c) for c in contexts[row:stop]])
        data = np.frombuffer(b"".join(contexts[row:stop]), np.uint8)
        strings = lengths - MATCH + 1
        begins = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(row, stop), strings)
        place = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
        hashes.append(rolling_hashes(prefix_sums(data), MATCH)[np.repeat(begins, strings) + place])
        owners.append(owner)
        places.append(place)
        row = stop
    owner, place, whole = (np.concatenate(x) for x in (owners, places, hashes))
    order = np.lexsort((whole, leads[owner]))  # stable: the earliest of equal strings comes first
    lead, text = leads[owner][order], whole[order]
    opens = np.concatenate(([True], (lead[1:] != lead[:-1]) | (text[1:] != text[:-1])))
    earliest = order[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
    # repeated rows of a document may be cut into contexts at different places
    document, position = document[owner], start[owner] + place
    repeat = np.zeros(len(owner), bool)
    repeat[order] = (document[earliest] != document[order]) | (position[earliest] != position[order])
    owner, place = owner[repeat], place[repeat]
    cut = np.flatnonzero((owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)) + 1 if len(owner) else []
    for lo, hi in zip(np.concatenate(([0], cut)).astype(int).tolist() if len(owner) else [],
                      np.concatenate((cut, [len(owner)])).astype(int).tolist()):
        o = owner[lo]
        yield int(doc[o]), int(version[o]), int(start[o] + place[lo]), int(start[o] + place[hi - 1] + MATCH)


def _earliest_rows(rows: pa.Table) -> tuple[pa.Table, list[tuple[int, int, int, int]]]:
    """The earliest of equal contexts, and the spans of the others."""
    doc, version, start = (rows[c].to_numpy() for c in ("doc", "version", "start"))
    rows = rows.take(pa.array(np.lexsort((start, version, doc))))
    seen: dict[tuple, tuple] = {}
    keep, spans = [], []
    for i, r in enumerate(zip(*(rows[c].to_pylist() for c in ("lead", "at", "context", "doc", "version", "start")))):
        if seen.setdefault(r[:3], r[3:]) == r[3:]:
            keep.append(i)
        else:
            spans.append((r[3], r[4], r[5], r[5] + len(r[2])))
    return rows.take(pa.array(keep, pa.int64())), spans


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, version, spans): the merged [start, stop) byte ranges to remove
    from each document that has any; NO_ID stands for a NULL id."""
    source = _source(docs)
    long = source.where(F.octet_length("text") >= MATCH)
    rows = shared_table(whole_repeats(long, *lead_bitmap(shared_table(repeated_leads(long), "repeated-leads"))),
                        "whole-repeats")
    ends = rows.where("several").select("lead").distinct()
    # sampling the splitters scans once more; a written table would double the disk
    suffixes = anchored_suffixes(long, *lead_bitmap(shared_table(ends, "several-contexts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(spans) -> pa.RecordBatch:
            return _spans(list(zip(*spans)) or [()] * 4)
        carried = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if carried is not None:
                table = pa.concat_tables([carried, table])
            if not table.num_rows:
                continue
            lead = table["lead"].to_numpy()
            own = np.flatnonzero(lead != lead[-1])
            whole = int(own[-1]) + 1 if len(own) else 0  # the last lead may go on
            if whole:
                yield out(_bucket(table.slice(0, whole).combine_chunks()))
            carried = table.slice(whole).combine_chunks()
            if carried.num_rows > CARRIED:  # a very common lead: equal contexts count once
                carried, spans = _earliest_rows(carried)
                yield out(spans)
        if carried is not None and carried.num_rows:
            yield out(_bucket(carried))
    buckets = suffixes.repartitionByRange("key", "lead").sortWithinPartitions("key", "lead")
    found = buckets.select("lead", "at", "context", "doc", "version", "start") \
        .mapInArrow(run, "doc long, version long, start long, stop long")
    spans = found.unionByName(rows.where("again").select("doc", "version", "start", "stop"))
    # a document's spans are at most its bytes
    return spans.groupBy("doc", "version").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """The text without the spans (sorted, maybe overlapping), and the number
    of maximal removed runs."""
    if not spans:
        return text, 0
    parts, done, runs, stop = [], 0, 0, -1
    for span in spans:
        lo, hi = span["start"], span["stop"]
        if lo > stop:
            parts.append(text[done:lo])
            runs += 1
        stop = max(stop, hi)
        done = stop
    parts.append(text[done:])
    return b"".join(parts), runs


def _with_spans(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one column each, beside their spans."""
    found = repeated_spans(docs)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(docs["text"]).alias("version"))
    return rows.join(found, ["doc", "version"], "left").select("row", "spans")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with the repeated passages cut out of
    ``text``; a character that a cut splits goes as a whole, and ``n_chars``,
    if there, counts anew.  Every document stays."""
    def cut_out(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row = batch["row"]
        columns = dict(zip((f.name for f in row.type), row.flatten()))
        cut = [s is not None for s in batch["spans"].to_pylist()]
        texts = [t if s is None else _kept(t.encode(), s)[0].decode("utf-8", "ignore")
                 for t, s in zip(columns["text"].to_pylist(), batch["spans"].to_pylist())]
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            columns["n_chars"] = pa.array([len(t) if c else n for t, c, n in zip(
                texts, cut, columns["n_chars"].to_pylist())], columns["n_chars"].type)
        yield pa.record_batch(list(columns.values()), list(columns))
    return _with_spans(docs).mapInArrow(lambda batches: _each(batches, cut_out), docs.schema)


def removal_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                kept, runs = _kept(text, spans)
                rows.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]),
                                   pa.array(columns[3], pa.string())],
                                  ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return _with_spans(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("row.text"), F.lit("")).cast("binary").alias("text"), "spans") \
        .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents, removed."""
    from skylane.llm.common import read_table
    return removal_digest(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, unnest(range(CAST(length(h) / 2 AS BIGINT))) AS i FROM d),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte,
             CASE WHEN 2 * i + 200 <= length(h) THEN md5_number(substr(h, 2 * i + 1, 200)) END AS string FROM b),
f AS (SELECT doc_id, i, byte,
             string IS NOT NULL AND row_number() OVER (PARTITION BY string ORDER BY doc_id, i) > 1 AS again FROM w),
c AS (SELECT doc_id, i, byte, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM f),
o AS (SELECT doc_id, i, byte, gone, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
a AS (SELECT doc_id, count(*) AS n, sum(gone::INT) AS removed, sum(opens::INT) AS spans,
             string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM o GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a ON a.doc_id = d.doc_id
"""
