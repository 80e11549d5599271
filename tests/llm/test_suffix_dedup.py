import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from skylane.llm import common, suffix_dedup
from skylane.llm.suffix_dedup import remove_repeats, removal_digest
from tests.llm.conftest import documents


def brute(docs):
    """Digest of each document; rows of one id and text are one document."""
    order = sorted({(i, t or "") for i, t in docs}, key=lambda x: (x[0] is not None, x[0] or 0))
    seen, out = set(), {}
    for key in order:
        b = key[1].encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept)
    return out


def fixture():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (99, 100, 101, 160, 400, 1500)]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 200)), rng.choice(shared), text(rng.randrange(0, 5)), rng.choice(shared)]
        docs.append((i, "".join(parts)))
    docs.append((70, docs[4][1]))  # an exact copy
    docs.append((71, docs[5][1][:150] + "!" + docs[5][1][150:]))  # an edit
    docs += [(80, "a" * 5000), (81, "ab" * 1000), (82, None), (83, ""), (84, "short"), (None, docs[6][1]),
             (7, docs[7][1]), (90, "x" + docs[8][1] * 3)]
    return docs


def test_against_brute_force(spark):
    docs = fixture()
    want = brute(docs)
    rows = removal_digest(documents(spark, docs)).collect()
    got = sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in rows)
    assert got == sorted(str((i, *want[(i, t or "")][:4])) for i, t in docs)


def test_small_segments_and_crowded_leads(spark, monkeypatch):
    """Pieces, carried rows and buckets far smaller than in production."""
    docs = fixture()
    rows = suffix_dedup._source(documents(spark, docs)).toArrow().combine_chunks().to_batches()[0]
    data, ends, _ = suffix_dedup._texts(rows["text"])
    whole = {(a, f, e) for run in suffix_dedup.anchor_runs(data, ends) for a, f, e in zip(*(x.tolist() for x in run[:3]))}
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    parts = {(a, f, e) for run in suffix_dedup.anchor_runs(data, ends) for a, f, e in zip(*(x.tolist() for x in run[:3]))}
    starts = lambda runs: {(a, s) for a, f, e in runs for s in range(f, e - 99)}
    assert starts(whole) == starts(parts)


def test_remove_repeats_keeps_rows_and_columns(spark):
    passage = "".join(f"päßage {i} " for i in range(20))
    docs = documents(spark, [(1, "one " + passage, 10), (2, passage + "zwei", 20), (3, None, None), (4, "short", 5)],
                     "doc_id long, text string, n_chars long")
    out = remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("one " + passage, 10), 2: ("zwei", 4), 3: (None, None), 4: ("short", 5)}
    assert remove_repeats(docs.limit(0)).count() == 0


def test_a_scan_takes_little_memory(monkeypatch):
    """A batch's arrays are small pieces, its bytes are not copied, and the
    tables of the worker's earlier operator go."""
    monkeypatch.setattr(common, "_kept", {"earlier": bytearray(1 << 20)})
    rng = np.random.default_rng(4)
    column = pa.array([rng.integers(97, 123, 1 << 20, dtype=np.uint8).tobytes() for _ in range(4)], pa.binary())
    tracemalloc.start()
    data, ends, raw = suffix_dedup._texts(column)
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    assert bytes(raw[:8]) == column[0].as_py()[:8] and len(data) == ends[-1] == 4 << 20
    found = sum(len(run[0]) for run in suffix_dedup.anchor_runs(data, ends))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 100_000 and peak < 40 << 20
    assert "earlier" not in common._kept
    for empty in (pa.array([], pa.binary()), pa.array([b"", b""], pa.binary())):
        data, ends, raw = suffix_dedup._texts(empty)
        assert not len(data) and not len(raw) and not ends.any()


def test_repeated_rows_cut_at_different_places():
    """A document's second row, whose context a piece's end cuts, repeats nothing."""
    rng = random.Random(5)
    text = bytes(rng.randrange(97, 123) for _ in range(168))

    def rows(*placed):
        doc, start, context = zip(*placed)
        return pa.table({"lead": [7] * len(doc), "at": [68 - s for s in start], "context": pa.array(context, pa.binary()),
                         "doc": doc, "version": [1] * len(doc), "start": start})
    own = [(1, 0, text), (1, 0, text[:129]), (1, 30, text[30:])]
    assert list(suffix_dedup._bucket(rows(*own))) == []
    assert list(suffix_dedup._bucket(rows(*own, (2, 30, text[30:])))) == [(2, 1, 30, 168)]
