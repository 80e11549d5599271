import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from skylane.llm.chat import LAYOUTS, Template, canonical_turns, fingerprint, read_back, unescaped
from tests.llm.conftest import documents

TEXTS = ["", "plain", "a\\b", "\\", "\\\\<s>", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "<<SYS>>\\<", "[[INST]",
         "<\\s>", "é\n日本 <|", "<<|im_end|>", None]


def test_round_trip(spark):
    rows = [(i, j, role, text) for i, role in enumerate(["user", "assistant", "a\nb\\", "<s>", None])
            for j, text in enumerate(TEXTS)]
    template = Template()
    read = template.reader()
    turns = documents(spark, rows, "conv_id long, turn long, role string, text string")
    for r in template.formatted(turns).collect():
        assert read(r.segment) == (r._r, r._t)
        inner = r.segment[len(template.opens):-len(template.closes)]
        assert not any(c in inner for c in template.controls)
        assert (r.loss_start is not None) == (r._r == "assistant")
        if r.loss_start is not None:
            assert unescaped(r.segment[r.loss_start:r.loss_start + r.loss_chars]) == r._t


def test_digests(spark):
    rows = [(1, 1, "assistant", "b\\"), (1, 0, "user", "a"), (1, 1, "assistant", "b\\"), (2, None, "assistant", None),
            (None, 0, None, "x"), (None, 1, "assistant", "<s>")]
    got = {r.conv_id: r for r in read_back(Template().formatted(documents(
        spark, rows, "conv_id long, turn long, role string, text string")), Template()).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (3, sha("user\na\nassistant\nb\\\nassistant\nb\\\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (4, sha("b\\b\\"))
    assert (got[2].n_turns, got[2].loss_chars, got[2].loss_sha256) == (1, 0, sha(""))
    assert (got[None].turns_sha256, got[None].loss_sha256) == (sha("\nx\nassistant\n<s>\n"), sha("<s>"))
    assert read_back(Template().formatted(documents(spark, [], "conv_id long, turn long, role string, text string")),
                     Template()).count() == 0


def test_layouts(spark):
    schema = ("key long, messages array<struct<role:string,content:string,weight:int>>, "
              "conversations array<struct<from:string,value:string>>, system string, prompt string, response string, "
              "instruction string, input string, output string, turn int, noise string")
    rows = [(1, [("user", "m1", 1), ("assistant", "m2", None)], *[None] * 9),
            (2, None, [("human", "h"), ("GPT", "g")], *[None] * 8),
            (3, None, None, "s", "p", "r", *[None] * 5),
            (4, None, None, None, "p", "r", *[None] * 4, "noise"),
            (5, None, None, None, None, None, "do", "this", "done", None, None),
            (6, None, None, "s", None, None, "do", None, "done", 7, None)]
    df = spark.createDataFrame(rows, schema)
    got = {}
    for r in canonical_turns(df, "key").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {1: [("user", "m1"), ("assistant", "m2")], 2: [("user", "h"), ("assistant", "g")],
                   3: [("system", "s"), ("user", "p"), ("assistant", "r")], 4: [("user", "p"), ("assistant", "r")],
                   5: [("user", "do\n\nthis"), ("assistant", "done")],
                   6: [("system", "s"), ("user", "do"), ("assistant", "done")]}
    odd = df.where("key = 3").selectExpr("key", "prompt")
    with pytest.raises(Exception, match="no mapping"):
        canonical_turns(odd, "key").collect()
    assert canonical_turns(odd, "key", unknown="skip").count() == 0


def test_fingerprints_differ():
    sets = [tuple(s) for x in LAYOUTS for s in x.field_sets()]
    assert len({fingerprint(list(s)) for s in sets}) == len(sets)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="\\ab<s>|[I]", max_size=20))
def test_unescaped_undoes(text):
    doubled = text.replace("\\", "\\\\")
    assert unescaped(re.sub("(?<=<)(?=s>)", r"\\", doubled)) == text


def test_rows_by_turn(spark):
    schema = "conv_id long, turn int, role string, text string, input string"
    rows = [(1, 0, "human", "q", None), (1, 1, "assistant", None, None), (None, 0, None, "x", None),
            (2, None, None, None, None), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in canonical_turns(df, "conv_id").collect()), key=str)
    assert got == sorted((row[:4] for row in rows), key=str)
    assert canonical_turns(df, "conv_id").schema["turn"].dataType.simpleString() == "bigint"
    mixed = spark.createDataFrame([(1, 0, "user", "q", "i")], schema)  # no mapping takes these fields together
    assert canonical_turns(mixed, "conv_id", unknown="skip").count() == 0
    # a column named like one of a table of turns does not matter where the others are missing
    other = spark.createDataFrame([(1, "p", "r", "t")], "key long, prompt string, response string, text string")
    assert [(r.turn, r.role, r.text) for r in canonical_turns(other, "key").collect()] == \
        [(0, "user", "p"), (1, "assistant", "r")]
