"""The byte transducer and the audit against plain versions, and odd rows."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from noticemill.llm import filter_audit as A

WORDS = ["a", "Bc", "é", "ÉÀ", "#x", "$", "100%", "you&me", "*", "a|b", "word", "Word", "中文", "\U0001f600", "x" * 40, "\x1f", "\x85", "\xa0", " ", "\x00"]
GAPS = [" ", "\t", "\n", "\v", "\f", "\r", "  ", " \r\n"]


def plain(text):
    words = (text or "").encode().split()
    return [len(words), len(set(words)), len(text or ""), sum("A" <= c <= "Z" for c in text or ""), sum(c in "#$%&*|" for c in text or "")]


def some_texts(n, seed=1):
    r = random.Random(seed)
    texts = [None, "", " ", "\n\n", "x", " x ", "é" * 500, "A" * 700, "#" * 300]
    for _ in range(n):
        texts.append("".join(r.choice(WORDS) + (r.choice(GAPS) if r.random() < 0.9 else "") for _ in range(r.randrange(0, 60))))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("block, piece", [(1 << 18, 1 << 22), (64, 1 << 22), (7, 200), (64, 1)])
def test_transducer_counts_like_a_plain_pass(monkeypatch, block, piece):
    monkeypatch.setattr(A, "BLOCK", block)
    monkeypatch.setattr(A, "SLICE", piece)
    monkeypatch.setattr(A, "POWERS", A._powers(A.BASE))
    monkeypatch.setattr(A, "INVERSES", A._powers(A.INVERSE))
    texts = some_texts(400)
    assert A.count_texts(pa.array(texts)).tolist() == [plain(t) for t in texts]
    assert A.count_texts(pa.array(texts).slice(5, 100)).tolist() == [plain(t) for t in texts[5:105]]
    assert A.count_texts(pa.array([], pa.string())).tolist() == []


def test_equal_hashes_are_told_apart_by_their_bytes():
    texts = some_texts(100, 2)
    data = np.frombuffer(b"".join((t or "").encode() + b" " for t in texts), np.uint8)
    last = np.cumsum([len((t or "").encode()) + 1 for t in texts]) - 1
    start, end = A._words(data, last)[3:5]
    found = A.distinct_words(data, np.searchsorted(last, start), start, end, np.full(len(start), 7, np.uint64), len(texts))
    assert found.tolist() == [plain(t)[1] for t in texts]


def plain_audit(rows, marks):
    """rows: (id, text, part); marks: id to (good, toxic)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = {}
    for i, t, p in rows:
        words, distinct, points, upper, symbols = plain(t)
        fails = {f for f, bad in zip("ABCDE", (
            words < 200, 100 * distinct < 50 * words, 100 * upper > 2 * points, symbols > 0, i is not None and i > least[t or ""])) if bad}
        good, toxic = marks.get(i, (False, False))
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                c = out.setdefault((p or "", "".join(order), step), Counter())
                c["removed"] += not gone and f in fails
                c["redundant"] += gone and f in fails
                c["good_lost"] += not gone and f in fails and good
                c["toxic_lost"] += not gone and f in fails and toxic
                c["unique_fails"] += fails == {f}
                gone = gone or f in fails
                c["kept"] += not gone
    for (p, order, step), c in list(out.items()):
        f = order[step - 1]
        c["shapley"] = sum(out[p, "".join(o), o.index(f) + 1]["removed"] for o in permutations("ABCDE"))
    return out


def test_odd_rows_against_a_plain_audit(spark):
    texts = some_texts(60, 3) + ["one two " * 150, "w1 " + " ".join(f"w{i}" for i in range(250)), "AB " * 220 + " ".join(f"#{i}" for i in range(230))] * 2
    rows = [(i // 2 * 2 if i % 7 == 0 else i, t, (None, "", "s", "t")[i % 4]) for i, t in enumerate(texts)]
    rows += [(None, "no id", "s"), (None, "no id", None), (3, texts[3], "s"), (3, texts[3], "s"), (900, "no id", "t")]
    docs = spark.createDataFrame([(*r, "x", 1, 2, True) for r in rows],
                                 "doc_id long, text string, source string, content string, n int, failed int, good boolean").repartition(5)
    labels = spark.createDataFrame([(3, 1, None), (3, 0, 1), (4, 1, 0), (None, 1, 1), (8, None, None), (10, 0, 1)], "doc_id long, quality int, toxic int")
    want = plain_audit(rows, {3: (True, True), 4: (True, False), 10: (False, True)})
    got = A.audit(docs, labels).collect()
    assert len(got) == len(want) == 600 * 3
    for r in got:
        c = want[r["part"], r["filter_order"], r["step"]]
        assert {k: r[k] for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")} == {
            k: c[k] for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}, r
    assert A.audit(docs.limit(0), labels).count() == 0
    assert A.audit(docs, labels.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0
