"""Packing documents into token sequences.

Documents are tokenised where they are read, and whole sequences are cut off
there; only the rests, shorter than a sequence, are dealt at random into groups,
so a group's size does not depend on the texts' lengths.  Each group is packed
on its own: the rests go first-fit decreasing into bins kept in a tournament
tree of free space, and what space the bins then have left is filled with ids
cut from the emptiest bins.  The last bin of a group is cut at powers of two,
which need no padding.

Defined results: a NULL or empty text is one document of just the end id; a
NULL ``doc_id`` stays NULL; every row is packed, also repeated ones; a very long text
is encoded whole by one task, and sends its group a checksum per whole sequence
and its rest; rests of equal length are taken in the group's order; an empty
table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from skylane.llm.common import kept, text_pieces

SEQUENCE = 2048
GROUP_DOCS = 4096
END_ID = 1
#: Entries of a worker's memory of encoded stems; beyond, it starts anew.
STEMS_KEPT = 400_000
#: Marks that are a token run of their own behind a letter.
MARKS = ".,;:!?"
#: Bytes of text that a task encodes at once.
PIECE = 1 << 20
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class ChunkEncoder:
    """Token ids of texts, kept by stem.

    The tokenizer never joins characters across a space, so a text's ids are
    those of its space-separated chunks in order.  A final punctuation mark
    after a letter is a token run of its own and A-Z is lower-cased by the
    tokenizer, so a chunk is a lower-case stem and maybe a mark; a stem met
    before is looked up.  Texts with the opening of a control token, and long
    stems, are encoded as they stand.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.stems: dict[str, bytes] = {"": b""}
        self.marks = [self.ids(c) for c in MARKS]

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def encoded(self, stems: list[str]) -> list[bytes]:
        """The ids of each stem; those not met before are encoded together, a
        space between them, and told apart by their places."""
        found = list(map(self.stems.get, stems))
        fresh = [i for i, x in enumerate(found) if x is None]
        if fresh:
            new = [stems[i] for i in fresh]
            coded = self.tokenizer.encode(" ".join(new), add_special_tokens=False)
            ids, starts = np.array(coded.ids, self.width).tobytes(), np.array([o[0] for o in coded.offsets], np.int64)
            ends = np.cumsum([len(p) + 1 for p in new])
            at = (np.searchsorted(starts, np.concatenate([[0], ends])) * np.dtype(self.width).itemsize).tolist()
            for i, p, lo, hi in zip(fresh, new, at, at[1:]):
                found[i] = x = ids[lo:hi]
                if len(p) <= 64:
                    self.stems[p] = x
        return found

    def chunk_ids(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``chunks``, one after the other, and their numbers."""
        _, offsets, data = chunks.buffers()
        ends = np.frombuffer(offsets, np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        mark = np.full(len(chunks), len(MARKS))
        long = np.flatnonzero(np.diff(ends) > 1)
        last, before = data[ends[1:][long] - 1], data[ends[1:][long] - 2]
        for k, c in enumerate(MARKS.encode()):
            mark[long[(last == c) & (before >= ord("a")) & (before <= ord("z"))]] = k
        stems = pc.if_else(pa.array(mark < len(MARKS)), pc.utf8_slice_codeunits(chunks, 0, -1), chunks).dictionary_encode()
        parts = self.encoded(stems.dictionary.to_pylist()) + self.marks + [b""]
        flat = np.frombuffer(b"".join(parts), self.width)
        lengths = np.array([len(x) for x in parts], np.int64) // np.dtype(self.width).itemsize
        part = np.column_stack([np.asarray(stems.indices), mark + (len(parts) - len(MARKS) - 1)]).ravel()
        return _laid_out(flat, lengths, part)[0], lengths[part].reshape(-1, 2).sum(axis=1)

    def text(self, text: str) -> bytes:
        return self.texts([text])[0].tobytes()

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text.  Only the distinct chunks are looked up; their
        ids are laid out by number."""
        if len(self.stems) > STEMS_KEPT:
            self.stems = {"": b""}
        plain = pa.array(["" if "<|" in t else t for t in texts], pa.large_string())
        chunks = pc.split_pattern(pc.ascii_lower(pc.replace_substring(plain, "\n", " ")), " ")
        ends = np.asarray(chunks.offsets) - chunks.offsets[0].as_py()
        coded = chunks.flatten().dictionary_encode()
        ids, done = _laid_out(*self.chunk_ids(coded.dictionary), np.asarray(coded.indices))
        at = done[ends]
        return [np.frombuffer(self.ids(t), self.width) if "<|" in t else ids[lo:hi] for t, lo, hi in zip(texts, at[:-1], at[1:])]


def _laid_out(flat: np.ndarray, lengths: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the runs of these ``lengths`` in ``flat``, those of each ``number``,
    one after the other, and where each begins and the last ends."""
    size = lengths[number]
    done = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat((np.cumsum(lengths) - lengths)[number] - done[:-1], size) + np.arange(done[-1])], done


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, space: int = SEQUENCE,
              with_ids: bool = False) -> DataFrame:
    """``docs`` (doc_id, part, text) as (doc_id, part, wide, n, crcs, ids): the
    number of ids with the end id, the CRCs of the whole sequences at the front,
    and the ids after those (all ids if ``with_ids``), little-endian, 2 bytes
    each (4 if ``wide``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"encoder-{tokenizer_path}", lambda: ChunkEncoder(tokenizer_path))
        for batch in batches:
            lo = 0
            for texts in text_pieces(batch["text"], PIECE):
                rows = []
                for ids in encoder.texts([t or "" for t in texts.to_pylist()]):
                    ids = np.append(ids, np.array([end_id], encoder.width))
                    whole = len(ids) - len(ids) % space
                    crcs = [zlib.crc32(ids[at:at + space].astype("<u4").tobytes()) for at in range(0, whole, space)]
                    rows.append((len(ids), crcs, (ids if with_ids else ids[whole:]).tobytes()))
                n, crcs, ids = zip(*rows)
                yield pa.record_batch([
                    batch["doc_id"].slice(lo, len(texts)).cast(pa.int64()), batch["part"].slice(lo, len(texts)),
                    pa.array([encoder.width is np.uint32] * len(n), pa.bool_()), pa.array(n, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())), pa.array(ids, pa.binary())], ["doc_id", "part", "wide", "n", "crcs", "ids"])
                lo += len(texts)
    return docs.select("doc_id", "part", "text").mapInArrow(
        run, "doc_id long, part long, wide boolean, n long, crcs array<long>, ids binary")


class FreeSpace:
    """Tournament tree over bins: each node holds the largest free space below
    it, so the first bin with room is found in one walk down."""

    def __init__(self, bins: int, space: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [space] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The first bin with ``size`` free; its space is taken."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        best[node] -= size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return bin_


def pack_lengths(lengths: list[int], space: int = SEQUENCE) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); every id lies in one
    piece.  Each sequence holds ``space`` ids or a power of two."""
    full, rests = [], []
    for doc, n in enumerate(lengths):
        full += [[(doc, at, space)] for at in range(0, n - space + 1, space)]
        if n % space:
            rests.append((n % space, doc, n - n % space))
    rests.sort(key=lambda r: (-r[0], r[1]))
    tree, bins = FreeSpace(len(rests), space), []
    for size, doc, start in rests:
        at = tree.first_fit(size)
        if at == len(bins):  # the tree's bins are opened in order
            bins.append([])
        bins[at].append((doc, start, size))
    done, open_ = [], []
    for b in bins:
        used = sum(p[2] for p in b)
        (done if used == space else open_).append((used, b))
    open_.sort(key=lambda x: -x[0])
    open_ = [[space - used, b] for used, b in open_]
    first, last = 0, len(open_) - 1
    while first < last:  # the emptiest bin gives its ids to the fullest one
        gap, b = open_[first]
        doc, start, size = open_[last][1].pop()
        take = min(gap, size)
        b.append((doc, start + size - take, take))
        if take < size:
            open_[last][1].append((doc, start, size - take))
        open_[first][0] -= take
        if not open_[first][0]:
            first += 1
        if not open_[last][1]:
            last -= 1
    out = full + [b for _, b in done] + [b for _, b in open_[:first]]
    for _, b in open_[first:last + 1]:
        out += _cut_at_powers(b, space)
    return out


def _cut_at_powers(pieces: list[tuple[int, int, int]], space: int) -> list[list[tuple[int, int, int]]]:
    total, out, queue = sum(p[2] for p in pieces), [], pieces[::-1]
    if total == space:
        return [pieces]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        row = []
        while room:
            doc, start, size = queue.pop()
            take = min(room, size)
            row.append((doc, start, take))
            if take < size:
                queue.append((doc, start + take, size - take))
            room -= take
        out.append(row)
    return out


def pack(docs: DataFrame, tokenizer_path: str, space: int = SEQUENCE, end_id: int = END_ID,
         group_docs: int = GROUP_DOCS, seed: int = 17, with_ids: bool = False) -> DataFrame:
    """Pieces of the packed sequences (columns ``PIECES``; ``ids array<int>``
    too if ``with_ids``).  The documents are dealt at random into as many
    groups as hold ``group_docs`` documents on average."""
    groups = max(1, -(-docs.count() // group_docs))
    dealt = docs.select("doc_id", "text", F.floor(F.rand(seed) * groups).cast("long").alias("part"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        width = "<u4" if group["wide"].iloc[0] else "<u2"
        ids = [np.frombuffer(raw, width) for raw in group["ids"]]
        doc_ids, lengths, crcs = group["doc_id"].tolist(), group["n"].tolist(), group["crcs"].tolist()
        part, rows = int(group["part"].iloc[0]), []
        for number, row in enumerate(pack_lengths(lengths, space)):
            offset = 0
            for doc, start, length in row:
                behind = 0 if with_ids else lengths[doc] - lengths[doc] % space  # ids that stayed in the scan
                if start < lengths[doc] - lengths[doc] % space:
                    crc = crcs[doc][start // space]
                else:
                    crc = zlib.crc32(ids[doc][start - behind:start - behind + length].astype("<u4").tobytes())
                rows.append((doc_ids[doc], start, length, crc, lengths[doc], (part << 32) + number, offset)
                            + ((ids[doc][start:start + length].astype(np.int32),) if with_ids else ()))
                offset += length
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        out = pd.DataFrame(rows, columns=names + ["ids"] * with_ids)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return tokenised(dealt, tokenizer_path, end_id, space, with_ids).groupBy("part").applyInPandas(
        run, PIECES + (", ids array<int>" if with_ids else ""))


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers
    from skylane.llm.common import read_table
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
