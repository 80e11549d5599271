import re
import textwrap

from skylane.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, license_marks, needed, op2_license_scan, template_words
from tests.llm.conftest import documents


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    w = words(text)
    places = sorted((s, label) for phrase, label in PHRASES for p in [phrase.split()]
                    for s in range(len(w) - len(p) + 1) if w[s:s + len(p)] == p)
    blocks = set()
    for line, block in enumerate((text or "").split("\n")):
        for t in TEMPLATES:
            tw = template_words(t.text)
            both = len(set(tw) & set(words(block)))
            if both >= needed(len(tw), THRESHOLD):
                blocks.add((line, t.label, both / len(tw)))
    return len(w), places, blocks


def test_against_brute_force(spark):
    bsd = TEMPLATES[2].text
    texts = ["", None, "Under the MIT License.", "under the\nMIT, license under the mit license", "mit mit mit the license",
             "Apache License, Version 2.0", "CC BY-NC 4.0 and cc by nc", "x\n" + bsd.upper() + "\ny", bsd.replace("binary", "x"),
             " ".join(bsd.split()[::2]), bsd.replace(" ", "\n"), "This work is licensed under the GNU General Public License, version 3.",
             "word " * 20000 + "released under the mit license", "copyright reserved rights all", "MÍT license", "nc by cc"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[2]), (2, texts[2])]
    rows = license_marks(documents(spark, docs)).collect()
    assert len(rows) == len(docs)
    got = sorted(str((r.doc_id, r.n_words, sorted((p.start, p.label) for p in r.places),
                      sorted((b.line, b.label, b.containment) for b in r.blocks))) for r in rows)
    assert got == sorted(str((i, n, p, sorted(b))) for i, t in docs for n, p, b in [brute(t)])
    assert license_marks(documents(spark, [])).count() == 0


def brute_windows(text):
    w, out = words(text), set()
    for t in TEMPLATES:
        tw, length = set(template_words(t.text)), len(words(t.text))
        found = max(((len(tw & set(w[s:s + length])), -s) for s in range(len(w)) if w[s] in tw), default=(0, 0))
        if found[0] >= needed(len(tw), THRESHOLD):
            out.add((-found[1], t.label, found[0] / len(tw)))
    return out


def test_wrapped_licences(spark):
    """Hard-wrapped and commented licence texts are found, words of one that
    are scattered over a long text are not."""
    texts, labels = [], []
    for t in TEMPLATES:
        for mark in ("", " * ", "// ", "# "):
            lines = textwrap.wrap(t.text, 30 if len(t.text) < 120 else 72)
            texts.append("intro words here\n\n" + "\n".join(mark + line for line in lines) + "\n\nmore text the of")
            labels.append(t.label)
    mit = TEMPLATES[0].text
    texts += [mit.replace(" ", "\nfiller other "), "\n".join(textwrap.wrap(mit.replace("hereby", "x").replace("merge", "y"), 60)),
              TEMPLATES[2].text.replace(" ", "\n"), "the of and\n" * 3000, "", None]
    rows = license_marks(documents(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert {(w.start, w.label, w.containment) for w in r.windows} == brute_windows(texts[r.doc_id]), texts[r.doc_id]
        if r.doc_id < len(labels):
            assert labels[r.doc_id] in {w.label for w in r.windows}


def test_wrapped_licence_reaches_the_query(spark, tmp_path):
    text = "\n".join(textwrap.wrap(TEMPLATES[0].text, 72))
    documents(spark, [(1, text), (2, "plain")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.labels, r.score) for r in op2_license_scan(spark, str(tmp_path)).collect()}
    assert got == {1: ("mit", 1.0), 2: ("", 0.0)}
