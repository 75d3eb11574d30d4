"""Diagonal voting against a plain scan, and odd rows."""

import re

import pytest

from noticemill.llm import license_scan as L

BREAK = re.compile(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MIT = L.NOTICES[0].text


def words_of(text):
    return [w for w in BREAK.split((text or "").translate(str.maketrans(L.UPPER, L.LOWER))) if w]


def plain_scan(text):
    """Spans as (start, last, label, cover, base), by comparing every pair of neighbouring words with every template's."""
    words, spans = words_of(text), []
    for t in L.BASE + L.NOTICES:
        votes = sorted((i - j, j) for j in range(len(t.words) - 1) for i in range(len(words) - 1) if words[i:i + 2] == t.words[j:j + 2])
        groups = []
        for diagonal, place in votes:
            if not groups or diagonal - groups[-1][-1][0] > t.gap:
                groups.append([])
            groups[-1].append((diagonal, place))
        for g in groups:
            cover = len({p + k for _, p in g for k in (0, 1)}) / len(t.words)
            if cover >= t.cover:
                spans.append((min(d + p for d, p in g), max(d + p + 1 for d, p in g), t.label, cover, t.base))
    return len(words), sorted(spans)


@pytest.fixture(scope="module")
def rows():
    cut = MIT.replace("free of charge, ", "").replace("software and", "software product and")
    texts = [
        None, "", " ,.;", "MIT", "mit  License", "MIT-license. MIT LICENSE, the Apache/License", "General Public License", "General Public, Public License",
        "the GNU General Public License, version 3.", "general public license general public license", MIT, MIT.upper() + " " + MIT, cut,
        " ".join(MIT.split()[:12]), "Licensed under CC BY-NC 4.0.", "mit liçense mİt license Kit license mit licenſe",
        "word " * 3000 + "released under the MIT License " + "tail " * 3000, "All rights reserved. BSD license", "apache license version 2 0 " * 400,
        "mit" + "é license", "\U0001f600 mit license \U0001f600",
    ]
    return [(i if i != 5 else None, t, "x", 1, 2.0) for i, t in enumerate(texts)] + [(8, texts[8], "y", 1, 2.0), (8, "other text", "y", 1, 2.0)]


def test_scan_matches_a_plain_one(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, template int, score double").repartition(3)
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    got, want = [], []
    for r in L.scan(docs).collect():
        spans = [(s["start"], s["last"], s["label"], round(s["cover"], 9), s["base"]) for s in r["spans"]]
        got.append((r["doc_id"], r["n_words"], spans, r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)))
    for i, t, *_ in rows:
        n, spans = plain_scan(t)
        base = [s for s in spans if s[4]]
        want.append((i, n, [(*s[:3], round(s[3], 9), s[4]) for s in spans], len(base), min((s[0] for s in base), default=None),
                     max((s[0] for s in base), default=None), ",".join(sorted({s[2] for s in base})), ",".join(sorted({s[2] for s in spans})),
                     round(max((s[3] for s in spans), default=0.0), 9)))
    shorten = lambda x: [(*r[:2], str(r[2]), *map(str, r[3:])) for r in x]
    assert sorted(shorten(got), key=key) == sorted(shorten(want), key=key)
    found = {r[0]: r[7] for r in want}
    assert found[10] == found[12] == "mit" and found[13] == "" and found[14] == "cc-by,cc-by-nc" and found[18] == "apache,apache-2.0"
    assert L.scan(docs.limit(0)).count() == 0


def test_templates_are_checked(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for bad in ("one", "café license"):
        with pytest.raises(ValueError):
            L.scan(docs, [L.Template("x", bad)])


def test_a_large_template_table_is_joined_without_broadcast_hint(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_BROADCAST_GRAMS", 1)
    docs = spark.createDataFrame([(1, "the MIT license")], "doc_id long, text string")
    assert L.scan(docs).first()["labels"] == "mit"
