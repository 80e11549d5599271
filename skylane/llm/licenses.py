"""Licence scans.

Three kinds of marks are found in one pass over the documents' words.

* Phrases: places where a licence phrase's words stand consecutively.
* Templates: text blocks (lines) that hold at least ``threshold`` of a
  template's distinct words.  This is an exact set-similarity join: the words
  of all templates are put in one global order, rarest in the corpus first; a
  block can only reach the threshold if it holds one of the template's first
  ``|T| - need + 1`` words in that order (prefix filter), has ``need`` distinct
  template words at all (length filter), and if the first word they share
  stands early enough in the template for ``need`` shared words to remain
  (positional filter).  What is left is compared word by word.
* Windows: runs of as many words as a template has, over any line breaks, that
  hold at least ``threshold`` of its distinct words, so that wrapped and
  commented licence texts are found; of each template the best window of a
  document, the first of equals.  A document is looked at for a template if it
  holds one of its prefix words and ``need`` distinct words of it at all; a
  window begins at a template word (a later begin loses nothing), and its
  ``need``-th template word must stand within the window before its words are
  compared.

A phrase is a template with threshold 1: its one prefix word is its rarest
word, and the places of that word are the candidates.

Defined results: NULL and empty texts have no words and no marks; repeated rows
and rows with a NULL ``doc_id`` each get a result; an empty table gives no
rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylane.llm.common import LOWER, SEPARATORS, UPPER, ascii_lower, let, word_array

# The phrases with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@dataclass(frozen=True)
class Template:
    """A licence text and its label."""

    label: str
    text: str


# Opening or grant paragraphs of public licences.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files, to deal in the Software without restriction, including without limitation "
             "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies"),
    Template("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the "
             "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
             "implied"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("gpl", "This work is licensed under the GNU General Public License"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial International License"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "Copyright all rights reserved"),
)
THRESHOLD = 0.8


def template_words(text: str) -> list[str]:
    """The distinct words of a template, by the documents' word rule."""
    return list(dict.fromkeys(w for w in re.split(SEPARATORS, text.translate(str.maketrans(UPPER, LOWER))) if w))


def window_length(text: str) -> int:
    """How many words a template has, repeated ones each."""
    return sum(bool(w) for w in re.split(SEPARATORS, text.translate(str.maketrans(UPPER, LOWER))))


def needed(size: int, threshold: float) -> int:
    """Fewest shared words that reach the threshold."""
    return math.ceil(round(threshold * size, 9))


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the (fixed, small) vocabulary stands."""
    held = F.array_intersect(word_array(F.col("text")), _literal(vocabulary))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["n"] for r in counts.collect()}


def _literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def prefix_index(spark: SparkSession, templates: tuple[Template, ...], order: dict[str, tuple],
                 threshold: float) -> DataFrame:
    """One row per prefix word of each template: (word, template, at, label,
    words, need); ``at`` is the word's place in the template's order."""
    rows = []
    for number, template in enumerate(templates):
        words = sorted(template_words(template.text), key=order.__getitem__)
        need = needed(len(words), threshold)
        rows += [(words[at], number, at, template.label, words, need) for at in range(len(words) - need + 1)]
    return spark.createDataFrame(rows, "word string, template int, at int, label string, words array<string>, need int")


def license_marks(docs: DataFrame, phrases: tuple[tuple[str, str], ...] = PHRASES,
                  templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, n_words, places (array of (start, label) of
    the phrases), blocks (array of (line, label, containment)) and windows
    (array of (start, label, containment), one of each template met)."""
    spark = docs.sparkSession
    phrase_words = [p.split() for p, _ in phrases]
    by_template = [template_words(t.text) for t in templates]
    vocabulary = sorted({w for words in [*phrase_words, *by_template] for w in words})
    seen = word_frequencies(docs, vocabulary)
    order = {w: (seen[w], w) for w in vocabulary}

    # phrases: (rarest word, its place, words, label)
    rare = [min(range(len(p)), key=lambda i, p=p: order[p[i]]) for p in phrase_words]
    index = prefix_index(spark, templates, order, threshold)
    prefixes: dict[int, list[str]] = {}
    for r in index.select("template", "word").distinct().collect():  # words of the fixed templates
        prefixes.setdefault(r["template"], []).append(r["word"])
    prefix_words = sorted({w for held in prefixes.values() for w in held})
    least = min((needed(len(w), threshold) for w in by_template), default=0)

    def phrase_places(words: Column, phrase: list[str], at: int, label: str) -> Column:
        starts = F.filter(F.transform(words, lambda w, i: F.when(w == phrase[at], i - at)), lambda s: s >= 0)
        whole = F.filter(starts, lambda s: F.slice(words, s + 1, len(phrase)) == _literal(phrase))
        held = F.transform(whole, lambda s: F.struct(s.alias("start"), F.lit(label).alias("label")))
        return F.when(F.array_contains(words, phrase[at]), held).otherwise(
            F.expr("cast(array() as array<struct<start:int,label:string>>)"))

    def places(words: Column) -> Column:
        return F.flatten(F.array(*[phrase_places(words, phrase, at, label)
                                   for phrase, at, (_, label) in zip(phrase_words, rare, phrases)]))

    def candidate_lines(text: Column) -> Column:
        """(line, its distinct template words) of lines with a prefix word."""
        lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(
            i.alias("line"), F.array_intersect(word_array(line), _literal(vocabulary)).alias("held")))
        return F.filter(lines, lambda x: (F.size(x["held"]) >= least)
                        & F.arrays_overlap(x["held"], _literal(prefix_words)))

    def best_window(words: Column, number: int) -> Column:
        """The window of a template; NULL without one."""
        template, length = by_template[number], window_length(templates[number].text)
        need = needed(len(template), threshold)

        def best(held: Column) -> Column:
            first = lambda i: F.element_at(held, i + 1)["at"]
            starts = F.filter(F.sequence(F.lit(0), F.size(held) - need),
                              lambda i: F.element_at(held, i + need)["at"] < first(i) + length)
            counted = F.transform(starts, lambda i: let(first(i), lambda at: F.struct(
                F.size(F.array_distinct(F.transform(F.filter(F.slice(held, i + 1, length), lambda x: x["at"] < at + length),
                                                    lambda x: x["word"]))).alias("shared"), (-at).alias("before"))))
            return let(F.array_max(counted), lambda b: F.when(b["shared"] >= need, F.struct(
                (-b["before"]).alias("start"), F.lit(templates[number].label).alias("label"),
                (b["shared"] / len(template)).alias("containment"))))
        held = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                        lambda x: F.array_contains(_literal(template), x["word"]))
        return F.when(F.arrays_overlap(words, _literal(sorted(prefixes[number])))
                      & (F.size(F.array_intersect(words, _literal(template))) >= need), let(held, best))

    def windows(words: Column) -> Column:
        return F.filter(F.array(*[best_window(words, n) for n in range(len(templates))]), lambda w: w.isNotNull())

    def marks(words: Column) -> Column:
        maybe = F.arrays_overlap(words, _literal(prefix_words))
        none = F.expr("cast(array() as array<struct<line:int,held:array<string>>>)")
        no_windows = F.expr("cast(array() as array<struct<start:int,label:string,containment:double>>)")
        return F.struct(F.size(words).alias("n_words"), places(words).alias("places"),
                        F.when(maybe, windows(words)).otherwise(no_windows).alias("windows"),
                        F.when(maybe, candidate_lines(F.coalesce("text", F.lit("")))).otherwise(none).alias("lines"))
    scanned = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row"),
                          let(word_array(F.col("text")), marks).alias("m")) \
        .select("doc_id", "_text", "_row", "m.n_words", "m.places", "m.windows", F.explode_outer("m.lines").alias("l"))
    # prefix filter: an equi-join on the words of the line with the index of
    # the templates' prefix words (a fixed, small table)
    met = scanned.select("doc_id", "_text", "_row", "n_words", "places", "windows", "l.line", "l.held",
                         F.explode_outer("l.held").alias("word")) \
        .join(F.broadcast(index), "word", "left")
    shared = F.size(F.array_intersect("held", "words"))
    long_enough = F.size("held") >= F.col("need")
    early_enough = F.size("words") - F.col("at") >= F.col("need")
    reached = F.when(long_enough & early_enough & (shared >= F.col("need")), F.struct(
        F.col("line"), F.col("label"), (shared / F.size("words")).alias("containment")))
    # one row per document: what stays of the lines is a handful of marks
    return met.groupBy("doc_id", "_text", "_row").agg(
        F.first("n_words").alias("n_words"), F.first("places").alias("places"),
        F.collect_set(reached).alias("blocks"), F.first("windows").alias("windows")).drop("_text", "_row")


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence marks of every document."""
    from skylane.llm.common import read_table
    found = license_marks(read_table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.concat(*[F.transform(c, lambda b: b["label"]) for c in ("blocks", "windows")])
    best = F.array_max(F.concat(*[F.transform(c, lambda b: b["containment"]) for c in ("blocks", "windows")]))
    return found.select(
        "doc_id", F.col("n_words").cast("long"), F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))


def oracle_sql() -> str:
    """DuckDB SQL of the query: phrase places by word position, templates by
    counting the shared words of every line."""
    held = [(i, t.label, template_words(t.text)) for i, t in enumerate(TEMPLATES)]
    rows = ", ".join(f"({i}, '{label}', {len(words)}, {needed(len(words), THRESHOLD)}, '{w}')"
                     for i, label, words in held for w in words)
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    split = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, s, '{label}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS s FROM d "
        f"WHERE len(w) >= {n}) WHERE array_to_string(w[s:s + {n - 1}], ' ') = '{phrase}'"
        for phrase, label in PHRASES for n in [len(phrase.split())])
    return f"""
WITH t(template, label, size, need, word) AS (VALUES {rows}),
d AS (SELECT doc_id, {split.format(lower)} AS w FROM documents),
p AS ({phrases}),
b AS (SELECT doc_id, count(*) AS n, min(s) - 1 AS lo, max(s) - 1 AS hi FROM p GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split({lower}, chr(10))) AS line, generate_subscripts(string_split({lower}, chr(10)), 1) AS i
      FROM documents WHERE doc_id IS NOT NULL),
lw AS (SELECT doc_id, i, unnest(list_distinct({split.format('line')})) AS word FROM l),
c AS (SELECT doc_id, label, count(*) / size AS containment FROM lw JOIN t USING (word)
      GROUP BY doc_id, i, template, label, size, need HAVING count(*) >= need),
a AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM p UNION ALL SELECT doc_id, label FROM c) GROUP BY doc_id),
bl AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY doc_id),
m AS (SELECT doc_id, max(containment) AS containment FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
       coalesce(bl.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(m.containment, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN m USING (doc_id)
"""
