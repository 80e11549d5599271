import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st

from skylane.llm.packing import ChunkEncoder, FreeSpace, pack, pack_lengths
from tests.llm.conftest import documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_every_id_in_one_piece_and_no_padding(lengths):
    got = defaultdict(list)
    for row in pack_lengths(lengths, 16):
        size = sum(n for _, _, n in row)
        assert size == 16 or size & (size - 1) == 0
        for doc, start, n in row:
            assert n > 0
            got[doc] += range(start, start + n)
    assert {d: sorted(x) for d, x in got.items()} == {d: list(range(n)) for d, n in enumerate(lengths)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10), min_size=1, max_size=30))
def test_first_fit(sizes):
    tree, bins = FreeSpace(len(sizes), 10), []
    for s in sizes:
        want = next((i for i, b in enumerate(bins) if b >= s), len(bins))
        if want == len(bins):
            bins.append(10)
        bins[want] -= s
        assert tree.first_fit(s) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAbZ é'st.,!?\n\t 09|<>東Σσ́ İ")), max_size=60))
def test_chunks_give_the_tokenizers_ids(text):
    encoder = ChunkEncoder.__new__(ChunkEncoder)
    encoder.__dict__.update(_shared().__dict__)
    assert encoder.text(text) == encoder.ids(text)


def test_a_stem_is_encoded_once():
    """Capitals and final marks make no entries of their own, in one text or
    in several."""
    encoder = ChunkEncoder(PATH)
    texts = ["Stem stem, STEM. stem! été, Été", "Stem? stem; stem: don't"]
    assert [ids.tobytes() for ids in encoder.texts(texts)] == [encoder.ids(t) for t in texts]
    assert sorted(encoder.stems) == ["", "don't", "stem", "Été", "été,"]


_kept = []


def _shared():
    if not _kept:
        _kept.append(ChunkEncoder(PATH))
    return _kept[0]


def test_pack_against_the_tokenizer(spark):
    rng = random.Random(8)
    words = ["alpha", "Beta,", "gamma.", "don't", "x1y2", "été", "<|endoftext|>", "a..b", "日本"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 300)))) for i in range(50)]
    docs += [(60, None), (61, ""), (62, "word " * 6000), (None, "no id"), (3, docs[3][1]), (63, "q" * 3000)]
    rows = pack(documents(spark, docs), PATH, group_docs=20, with_ids=True).collect()
    encoder = _shared()
    want = sorted([str((i, tuple(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) + (1,))) for i, t in docs])
    parts = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    whole = []
    for doc, pieces in parts.items():
        n = sum(p.length for p in pieces) // pieces[0].doc_tokens  # rows of one id
        ids = sorted({(p.start, tuple(p.ids)) for p in pieces}) if n > 1 else [(p.start, tuple(p.ids)) for p in sorted(pieces, key=lambda p: p.start)]
        if n == 1:
            whole.append(str((doc, tuple(x for _, piece in ids for x in piece))))
            assert sum(p.length for p in pieces) == pieces[0].doc_tokens
    assert set(whole) <= set(want) and len(whole) >= len(docs) - 2
    for row in sequences.values():
        row.sort(key=lambda p: p.offset)
        assert [p.offset for p in row] == np.cumsum([0] + [p.length for p in row[:-1]]).tolist()
        size = sum(p.length for p in row)
        assert size <= 2048 and (size == 2048 or size & (size - 1) == 0)
    assert pack(documents(spark, []), PATH).count() == 0


def test_long_texts_send_their_rests_only(spark):
    """Texts of a megabyte in one group: every id in one piece, checksums of the
    tokenizer's ids, and no more than a sequence of each text shipped."""
    from skylane.llm.packing import SEQUENCE, tokenised
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["alpha", "Beta,", "x1y2", "été"]) + str(rng.randrange(50)) for _ in range(120_000)))
            for i in range(3)] + [(9, "short")]
    df = documents(spark, docs)
    shipped = tokenised(df.selectExpr("doc_id", "0L part", "text"), PATH).collect()
    assert all(len(r.ids) < 2 * SEQUENCE and len(r.crcs) == r.n // SEQUENCE for r in shipped)
    want = {i: np.array(_shared().tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in docs}
    got = defaultdict(int)
    for r in pack(df, PATH).collect():
        own = want[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and zlib.crc32(own.tobytes()) == r.ids_crc32
        got[r.doc_id] += r.length
    assert got == {i: len(x) for i, x in want.items()}


def test_a_worker_keeps_one_operators_tables():
    from skylane.llm.common import kept
    first = kept("a", lambda: np.zeros(3))
    assert kept("a", lambda: None) is first
    second = kept("b", lambda: np.ones(3))
    assert kept("b", lambda: None) is second
    assert kept("a", lambda: None) is None  # let go when b was kept
