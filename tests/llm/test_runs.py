"""Periodic runs against a plain search, and the query against the contract done by hand."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from noticemill.llm import catalog, runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=12):
    n, found = len(words), {}
    codes = np.unique(np.array([*words, b""], object), return_inverse=True)[1][:n]
    for q in range(1, n // 2 + 1):
        same = np.concatenate(([0], (codes[q:] == codes[:-q]).astype(np.int8), [0]))
        change = np.diff(same)
        for x, y in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)):
            if y - x >= q and y - x + q >= least:
                found.setdefault((int(x), int(y + q)), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped)


def as_lists(texts, **options):
    codes = [np.array([w[0] for w in t], np.int64) for t in texts]
    out = [[] for _ in texts]
    for t, s, n, q in zip(*(c.tolist() for c in runs.find_runs(codes, **options))):
        out[t].append((s, n, q))
    return out


def some_texts(n, seed):
    r = random.Random(seed)
    texts = [[], [b"a"], [b"a"] * 11, [b"a"] * 12, [b"a"] * 333, [b"a", b"b"] * 6, [b"a"] * 100 + [b"x"] + [b"a"] * 100 + [b"x"] + [b"a"] * 90]
    for _ in range(n):
        letters = [bytes([40 + k]) for k in range(r.choice((2, 2, 3, 5, 50)))]
        t = []
        while len(t) < r.choice((5, 40, 200, 600)):
            piece = r.choices(letters, k=r.randrange(1, 40))
            t += (piece * r.randrange(1, 6))[: r.randrange(1, 200)]
        texts.append(t)
    fib = [[b"a"], [b"a", b"b"]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    texts.append(fib[-1])
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_a_plain_search(seed):
    texts = some_texts(60, seed)
    assert as_lists(texts) == [plain_runs(t) for t in texts]
    assert as_lists(texts[::-1], least=2) == [plain_runs(t, 2) for t in texts[::-1]]
    for t in texts[:20]:
        assert as_lists([t]) == [plain_runs(t)]


def test_odd_rows(spark, monkeypatch):
    texts = [None, "", " \t\n ", "one", "x " * 40, "a b c " * 5 + "tail", "a b c " * 5 + "tail", "Ünï 中文 " * 7 + "\U0001f600", "w " * 3 + "p q " * 30_000]
    texts += [" ".join(t.decode() for t in ts) for ts in some_texts(30, 9)]
    rows = [(None if i == 3 else i // 2 if i < 4 else i, t, i, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, runs string").repartition(3)
    got = {}
    for r in runs.periodic_runs(docs).collect():
        got.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["collapsed"]))
    want = {}
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        found = [(3, 60_000, 2)] if t and t.startswith("w w w p q") else plain_runs(words)
        want.setdefault(i, []).append((found, plain_collapsed(words, found).decode()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_slices_do_not_change_results(monkeypatch):
    import pyarrow as pa

    texts = pa.array([" ".join(t.decode() for t in ts) for ts in some_texts(40, 5)] + [None])
    whole = runs._batch(texts, 12).to_pylist()
    for size in (1, 500):
        monkeypatch.setattr(runs, "SLICE", size)
        assert runs._batch(texts, 12).to_pylist() == whole


def test_query_against_the_contract(spark):
    found = {r["doc_id"]: r for r in catalog.op11_periodic_runs(spark, SF).collect()}
    docs, planted = catalog.table(spark, SF, "documents").collect(), 0
    assert len(found) == len(docs)
    for d in docs:
        words, h = (d["text"] or "").encode().split(), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)], planted + 1
        want, r = plain_runs(words), found[d["doc_id"]]
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(want), *best)
        assert r["exponent_milli"] == (None if best[1] is None else 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, want)).hexdigest()
    assert planted > 5
