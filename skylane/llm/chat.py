"""Chat formatting.

Records of several layouts (message lists, prompt and response columns,
instructions with an optional input, rows by turn) become canonical turns.
The field paths that a record fills are hashed; the hash selects one of the
declared mappings below.  A template then marks the turns; control strings in
roles and texts are escaped so that the formatted text reads back exactly.

Defined results: a NULL role or text is empty; turns are ordered by turn (NULL
first), ties by role and text, and each repeated row is a turn of its own; a
NULL conversation id is a conversation; a record whose fields fit no mapping
raises an error, or gets no turns with ``unknown="skip"``; a row of a table of
turns is a turn even if all its fields are NULL; texts are formatted whole,
however long; an empty table gives no rows.  Only the mapped fields are read; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


@dataclass(frozen=True)
class Layout:
    """A declared mapping: ``turns`` lists (role, path) for single fields, or
    one ("*", "list[].role path", "list[].text path") for a list of messages.
    With ``turn`` each row is one turn, at the place that this column holds,
    and ("*", "role path", "text path") names its role and text; such a mapping
    serves tables that have all of its columns."""

    name: str
    turns: tuple[tuple[str, ...], ...]
    optional: tuple[str, ...] = ()
    turn: str | None = None

    def fields(self) -> list[str]:
        return sorted({path for turn in self.turns for path in turn[1:]} | ({self.turn} if self.turn else set()))

    def field_sets(self) -> list[list[str]]:
        """Every set of filled fields that this mapping takes."""
        needed = [p for p in self.fields() if p not in self.optional]
        return [sorted([*needed, *some]) for n in range(len(self.optional) + 1)
                for some in combinations(self.optional, n)]


LAYOUTS = (
    Layout("messages", (("*", "messages[].role", "messages[].content"),)),
    Layout("from_value", (("*", "conversations[].from", "conversations[].value"),)),
    Layout("prompt_response", (("system", "system"), ("user", "prompt"), ("assistant", "response")), ("system",)),
    Layout("prompt_completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), ("system",)),
    Layout("question_answer", (("system", "system"), ("user", "question"), ("assistant", "answer")), ("system",)),
    Layout("instruction", (("system", "system"), ("user", "instruction", "input"), ("assistant", "output")),
           ("system", "input")),
    Layout("turn_rows", (("*", "role", "text"),), ("turn", "role", "text"), "turn"),
)
#: Other names of the roles in message lists.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: list[str]) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: DataType, prefix: str = "") -> list[str]:
    """The leaf paths of a schema; ``[]`` marks list items."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def layouts_for(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> list[Layout]:
    """The mappings that can serve a table of this schema."""
    have = set(field_paths(df.schema))
    return [x for x in layouts if x.turn is None or set(x.fields()) <= have]


def layout_of(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The fingerprint of the mapped fields that each record fills."""
    known = {p for x in layouts_for(df, layouts) for p in x.fields()}
    held = sorted(p for p in field_paths(df.schema) if p in known)
    top = lambda p: p.split("[")[0].split(".")[0]
    return F.sha2(F.array_join(F.filter(F.array(*[F.when(F.col(f"`{top(p)}`").isNotNull(), F.lit(p)) for p in held])
                                        if held else F.array().cast("array<string>"),
                                        lambda p: p.isNotNull()), "\n"), 256)


def canonical_turns(df: DataFrame, conv_id: str, layouts: tuple[Layout, ...] = LAYOUTS,
                    unknown: str = "error") -> DataFrame:
    """(conv_id, turn, role, text) of records of any of the layouts."""
    have = set(field_paths(df.schema))
    turns = F.raise_error(F.concat(F.lit("no mapping for the fields of conversation "),
                                   F.coalesce(F.col(f"`{conv_id}`").cast("string"), F.lit("NULL")))) \
        if unknown == "error" else F.lit(None)
    turns = turns.cast(_TURNS)
    for layout in layouts_for(df, layouts):
        for fields in layout.field_sets():
            if set(fields) <= have:
                turns = F.when(F.col("_layout") == fingerprint(fields), _turns(layout, fields).cast(_TURNS)).otherwise(turns)
    named = df.withColumn("_layout", layout_of(df, layouts)).withColumn("_turns", turns)
    return named.select(F.col(f"`{conv_id}`").alias("conv_id"), F.explode("_turns").alias("_t")) \
        .select("conv_id", "_t.turn", "_t.role", "_t.text")


_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def _turns(layout: Layout, fields: list[str]) -> Column:
    if layout.turn:
        _, role, text = layout.turns[0]
        return F.array(F.struct(F.col(f"`{layout.turn}`").alias("turn"), F.col(f"`{role}`").alias("role"),
                                F.col(f"`{text}`").alias("text")))
    if layout.turns[0][0] == "*":
        _, role, text = layout.turns[0]
        items, role = role.split("[].")
        text = text.split("[].")[1]
        names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
        return F.transform(F.col(items), lambda m, i: F.struct(
            i.alias("turn"), F.coalesce(names[F.lower(m[role])], m[role]).alias("role"), m[text].alias("text")))
    out = []
    for role, *paths in layout.turns:
        held = [F.col(f"`{p}`").cast("string") for p in paths if p in fields]
        if held:
            out.append(F.struct(F.lit(len(out)).alias("turn"), F.lit(role).alias("role"),
                                F.concat_ws("\n\n", *held).alias("text")))
    return F.array(*out)


@dataclass(frozen=True)
class Template:
    """Marks of a turn and the strings that a text must not hold unescaped.
    No control string begins inside another one, and none holds a backslash."""

    opens: str = "<|im_start|>"
    closes: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>", "<s>", "</s>",
                                 "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learned: str = "assistant"

    def escaped(self, text: Column) -> Column:
        """Double each backslash and put one after the first character of each
        control string."""
        rest = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in self.controls)
        return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), rest, r"\\")

    def formatted(self, turns: DataFrame) -> DataFrame:
        """(conv_id, turn, segment, loss_start, loss_chars): the conversation
        is its segments in order; the loss mask lies on ``loss_chars`` code
        points from ``loss_start`` of a learned segment (else NULL)."""
        role = F.regexp_replace(self.escaped(F.coalesce("role", F.lit(""))), "\n", "\\\\\n")
        text = self.escaped(F.coalesce("text", F.lit("")))
        return turns.select(
            "conv_id", "turn", F.coalesce("role", F.lit("")).alias("_r"), F.coalesce("text", F.lit("")).alias("_t"),
            role.alias("_role"), text.alias("_text")).select(
                "conv_id", "turn", "_r", "_t",
                F.concat(F.lit(self.opens), "_role", F.lit("\n"), "_text", F.lit(self.closes)).alias("segment"),
                F.when(F.col("_r") == self.learned, len(self.opens) + F.char_length("_role") + 1).alias("loss_start"),
                F.when(F.col("_r") == self.learned, F.char_length("_text")).alias("loss_chars"))

    def reader(self):
        """A function from a segment to its (role, text)."""
        shape = re.compile(rf"{re.escape(self.opens)}((?:[^\\\n]|\\.)*)\n(.*){re.escape(self.closes)}", re.S)

        def read(segment: str) -> tuple[str, str]:
            role, text = shape.fullmatch(segment).groups()
            return unescaped(role), unescaped(text)
        return read


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def read_back(segments: DataFrame, template: Template) -> DataFrame:
    """Digest of each formatted conversation, read from its segments.

    The segments of a conversation stream through one task in order (a digest
    has one order), never gathered: memory holds one batch, whatever the
    length of a conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, rows, current = template.reader(), [], ()

        def done() -> None:
            if current:
                conv, turns, all_text, chars, loss, total = current[0]
                rows.append((conv, turns, all_text.hexdigest(), chars, loss.hexdigest(), total))

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = [c.split()[0] for c in DIGEST.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        for batch in batches:
            for conv, segment, start, length in zip(*(batch[c].to_pylist() for c in (
                    "conv_id", "segment", "loss_start", "loss_chars"))):
                if not current or current[0][0] != conv:
                    done()
                    current = ([conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0],)
                state = current[0]
                role, text = read(segment)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learned = unescaped(segment[start:start + length])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(segment)
            yield out()
            rows.clear()
        done()
        yield out()
    return segments.repartition("conv_id") \
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "_r", "_t") \
        .select(F.col("conv_id").cast("long").alias("conv_id"), "segment", "loss_start", "loss_chars") \
        .mapInArrow(run, DIGEST)


def op4_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, with one conversation that
    holds the template's own control strings."""
    from skylane.llm.common import read_table
    said = "</s>[INST] ok [/INST]"
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), "
                                        f"(-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)"))
    template = Template()
    return read_back(template.formatted(canonical_turns(turns, "conv_id")), template)


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
        + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|startoftext\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>')) AS text_chars,
      length(role) + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, chr(10), ''))
        + len(regexp_extract_all(role, '<\|im_start\|>|<\|im_end\|>|<\|startoftext\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>')) AS role_chars
      FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + role_chars + 1 + text_chars + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
