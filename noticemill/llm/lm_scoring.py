"""Prediction by partial matching over bytes, and a word unigram model beside it.

The model is a trie of byte contexts up to ``order``, counted over all training texts. A symbol that a
context has not seen is escaped to the next shorter one (method D: every different symbol of the context gives
half an occurrence to the escape), and what the longer context has seen is excluded there. The end of a text is a
symbol too, so probabilities of texts add up to at most one.

A symbol's code length depends on its ``order + 1``-gram alone. Counting and scoring therefore work on
the distinct grams of a chunk of texts, and shorter orders are sums over the longest. The trie is a DataFrame per order
and grows with the texts: no task and no driver holds it. Grams are dealt by a hash of their context to buckets,
whose number grows with the texts too, and travel in compressed blocks, as words do. A bucket holds whole contexts, so what training has
gets its value there; only grams that training has not escape as rows. Each chunk gets back the counts and totals of its own grams.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches, written

BITS = 9
END, START = 256, 257
SYMBOLS = 257  # bytes and the end can be predicted, the start cannot


def mask(symbols: int) -> np.int64:
    return np.int64((1 << (BITS * symbols)) - 1)


def gram_keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``order + 1``-grams that end at each symbol to predict, and how many each text has."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    symbols = np.full(int(sizes.sum()) + order * len(texts), START, np.int64)
    ends = np.cumsum(sizes + order)
    for text, end in zip(texts, ends):
        symbols[end - 1] = END
        symbols[end - 1 - len(text): end - 1] = np.frombuffer(text, np.uint8)
    keys = np.zeros(len(symbols), np.int64)
    for k in range(order + 1):
        keys[k:] |= symbols[: len(symbols) - k] << np.int64(BITS * k)
    return keys[symbols != START], sizes


def in_slices(texts: list[bytes], size: int = 1_000_000) -> Iterator[list[bytes]]:
    """The texts in runs of about ``size`` bytes, one text at least, so that arrays over their symbols stay small."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


class Trie:
    """Counts of the grams of all orders, as sorted arrays, with what exclusion needs: ``open_logs`` in memory, for small models."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``grams[k]``: sorted keys of ``k + 1`` symbols and their counts."""
        self.grams = grams
        self.contexts = []
        for k, (keys, counts) in enumerate(grams):
            context, first = np.unique(keys >> BITS, return_index=True)
            bounds = np.append(first, len(keys))
            total = np.add.reduceat(counts, first) if len(keys) else counts
            excluded = np.zeros(len(context), np.int64)
            if k and len(keys):
                shorter, n = grams[k - 1]
                excluded = np.add.reduceat(n[np.searchsorted(shorter, keys & mask(k))], first)
            self.contexts.append((context, total, np.diff(bounds).astype(np.int32), excluded.astype(np.int64)))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's last symbol after the others."""
        out = np.zeros(len(keys))
        open_ = np.arange(len(keys))
        seen_kinds = np.zeros(len(keys))  # of what the longer context excludes: kinds, and their total here
        seen_total = np.zeros(len(keys))
        for k in range(len(self.grams) - 1, -1, -1):
            context, total, kinds, excluded = self.contexts[k]
            gram, counts = self.grams[k]
            if not len(gram):
                continue
            own = keys[open_] & mask(k + 1)
            at = np.minimum(np.searchsorted(context, own >> BITS), len(context) - 1)
            known = context[at] == own >> BITS
            place = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
            hit = known & (gram[place] == own)
            new_kinds = np.where(known, kinds[at] - seen_kinds[open_], 0)
            rest = np.where(known, total[at] - seen_total[open_], 0)
            out[open_[hit]] += np.log10((counts[place[hit]] - 0.5) / rest[hit])
            escaped = known & ~hit & (new_kinds > 0)
            out[open_[escaped]] += np.log10(0.5 * new_kinds[escaped] / rest[escaped])
            seen_kinds[open_] = np.where(known, kinds[at], 0)
            seen_total[open_] = np.where(known, excluded[at], 0)
            open_ = open_[~hit]
        out[open_] -= np.log10(SYMBOLS - seen_kinds[open_])
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probabilities of whole texts."""
        out = [np.zeros(0)]
        for part in in_slices(texts):
            keys, sizes = gram_keys(part, len(self.grams) - 1)
            distinct, inverse = np.unique(keys, return_inverse=True)
            out.append(np.add.reduceat(self.log10(distinct)[inverse], np.cumsum(sizes) - sizes))
        return np.concatenate(out)


def packed(texts: list[bytes]) -> bytes:
    return zstandard.compress(b"".join(texts), 6)


def unpacked(data: bytes, sizes: np.ndarray) -> list[bytes]:
    whole, ends = zstandard.decompress(data), np.cumsum(sizes).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def chunked(docs: DataFrame, id_col: str, text_col: str, held_out: Column, chunk_bytes: int) -> DataFrame:
    """Texts in compressed chunks of about ``chunk_bytes`` (one text at least)."""
    bounded_batches(docs.sparkSession)

    def chunk_row(number: int, rows: list[tuple]) -> pd.DataFrame:
        part = TaskContext.get().partitionId()
        return pd.DataFrame({
            "chunk": [(part << 32) + number], "doc_ids": [[None if pd.isna(r[0]) else int(r[0]) for r in rows]],
            "held_out": [[r[1] for r in rows]], "sizes": [[len(r[2]) for r in rows]], "texts": [packed([r[2] for r in rows])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size, number = [], 0, 0
        for batch in batches:
            for doc_id, held, text in zip(batch["doc_id"], batch["held"], batch["text"]):
                data = (text or "").encode("utf-8", "replace")
                rows.append((doc_id, bool(held), data))
                size += len(data)
                if size >= chunk_bytes:
                    yield chunk_row(number, rows)
                    rows, size, number = [], 0, number + 1
        if rows:
            yield chunk_row(number, rows)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held"), F.col(text_col).alias("text")).mapInPandas(
        run, "chunk long, doc_ids array<long>, held_out array<boolean>, sizes array<int>, texts binary")


def squeezed(values: np.ndarray) -> bytes:
    """Eight-byte values, compressed byte plane by byte plane."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def restored(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, by their differences."""
    return squeezed(np.diff(keys, prepend=np.int64(0)))


def restored_keys(data: bytes) -> np.ndarray:
    return np.cumsum(restored(data, np.int64))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams of one context share a bucket; there are at most ``SYMBOLS`` of them."""
    mixed = (keys >> BITS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def merged_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    merged, where = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    return merged, np.bincount(where, np.concatenate([np.zeros(0), *counts]), len(merged)).astype(np.int64)


def chunk_grams(chunks: DataFrame, order: int, buckets: int) -> DataFrame:
    """The distinct grams of each chunk, by bucket: ``bucket, chunk, grams, n``; ``n`` counts in texts not held out."""
    bounded_batches(chunks.sparkSession, 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, data, sizes, held in zip(batch["chunk"], batch["texts"], batch["sizes"], batch["held_out"]):
                texts, keys, n = unpacked(data, sizes), [], []
                for out in (False, True):
                    for part in in_slices([t for t, h in zip(texts, held) if h == out]):
                        new, times = np.unique(gram_keys(part, order)[0], return_counts=True)
                        keys.append(new)
                        n.append(np.zeros(len(new), np.int64) if out else times)
                keys, n = merged_counts(keys, n)
                numbers, parts = by_bucket(bucket_of(keys, buckets))
                yield pd.DataFrame({"bucket": numbers, "chunk": chunk, "grams": [squeezed_keys(keys[p]) for p in parts],
                                    "n": [squeezed(n[p]) for p in parts]})

    return chunks.select("chunk", "texts", "sizes", "held_out").mapInPandas(run, "bucket int, chunk long, grams binary, n binary")


def by_bucket(own: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The different values of ``own`` and the places of each, in order."""
    order = np.argsort(own, kind="stable")
    numbers, first = np.unique(own[order], return_index=True)
    return numbers.tolist(), np.split(order, first[1:])


# --- words ----------------------------------------------------------------------------------------

def word_numbers(texts: list[bytes], buckets: int) -> tuple[list[np.ndarray], list[bytes], np.ndarray]:
    """The words of each text by number, the different words of all by that number, and their buckets."""
    numbers: dict[bytes, int] = {}
    own = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in text.lower().split()), np.int64) for text in texts]
    return own, list(numbers), np.fromiter((zlib.crc32(w) % buckets for w in numbers), np.int32, len(numbers))


def word_counts(chunks: DataFrame, buckets: int) -> DataFrame:
    """``chunk, bucket, c, tokens, kinds``: training counts of the different words of each chunk, in the order of ``word_numbers``.

    Words travel once, as a block a chunk and bucket. ``tokens`` and ``kinds`` are a bucket's, on one of its rows.
    """
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, data, sizes, held in zip(batch["chunk"], batch["texts"], batch["sizes"], batch["held_out"]):
                own, words, bucket = word_numbers(unpacked(data, sizes), buckets)
                n = np.bincount(np.concatenate([np.zeros(0, np.int64), *(o for o, h in zip(own, held) if not h)]), minlength=len(words))
                numbers, places = by_bucket(bucket)
                if numbers and len(words):
                    yield pd.DataFrame({"bucket": numbers, "chunk": chunk, "n": [squeezed(n[p]) for p in places],
                                        "words": [zstandard.compress(b" ".join([words[i] for i in p.tolist()]), 6) for p in places]})

    def count(group: pd.DataFrame) -> pd.DataFrame:
        numbers: dict[bytes, int] = {}
        own = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in zstandard.decompress(d).split(b" ")), np.int64) for d in group["words"]]
        c = np.zeros(len(numbers), np.int64)
        for o, n in zip(own, group["n"]):
            c[o] += restored(n, np.int64)  # a block has each of its words once
        out = pd.DataFrame({"chunk": group["chunk"], "bucket": group["bucket"], "c": [squeezed(c[o]) for o in own], "tokens": 0, "kinds": 0})
        out.iloc[0, 3:5] = int(c.sum()), int((c > 0).sum())
        return out

    bounded_batches(chunks.sparkSession, 1)
    dealt = chunks.select("chunk", "texts", "sizes", "held_out").mapInPandas(deal, "bucket int, chunk long, n binary, words binary")
    return dealt.groupBy("bucket").applyInPandas(count, "chunk long, bucket int, c binary, tokens long, kinds long")


# --- grams ----------------------------------------------------------------------------------------

def merged_blocks(blocks: DataFrame) -> DataFrame:
    """``bucket, grams, n`` with one row a bucket: the sorted keys of its blocks and their summed counts."""
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys, n = merged_counts([restored_keys(g) for g in group["grams"]], [restored(c, np.int64) for c in group["n"]])
        return pd.DataFrame({"bucket": [group["bucket"].iat[0]], "grams": [squeezed_keys(keys)], "n": [squeezed(n)]})

    return blocks.select("bucket", "grams", "n").groupBy("bucket").applyInPandas(merge, "bucket int, grams binary, n binary")


def trained(grams: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = restored_keys(grams), restored(n, np.int64)
    return keys[counts > 0], counts[counts > 0]


def shorter_grams(table: DataFrame, symbols: int, buckets: int) -> DataFrame:
    """The table of grams of ``symbols`` symbols from that of grams with one more."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for grams, n in zip(batch["grams"], batch["n"]):
                keys, counts = trained(grams, n)
                keys, counts = merged_counts([keys & mask(symbols)], [counts])
                numbers, places = by_bucket(bucket_of(keys, buckets))
                if len(keys):
                    yield pd.DataFrame({"bucket": numbers, "grams": [squeezed_keys(keys[p]) for p in places], "n": [squeezed(counts[p]) for p in places]})

    return merged_blocks(table.select("grams", "n").mapInPandas(cut, "bucket int, grams binary, n binary"))


def escaped(keys: np.ndarray, n: np.ndarray, k: int, grams: np.ndarray, logs: np.ndarray, seen: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """One order of the escapes: which ``grams`` the order-``k`` contexts know, their logs so far, and what these contexts have seen.

    ``keys, n``: trained grams of ``k + 1`` symbols, sorted, contexts whole. ``seen``: symbols that the longer context has seen, two bytes each.
    """
    own = grams & mask(k + 1)
    context = own >> BITS
    lo, hi = np.searchsorted(keys, context << BITS), np.searchsorted(keys, (context + 1) << BITS)
    below, ends = np.concatenate(([0], np.cumsum(n))), np.append(keys, np.int64(-1))  # no gram is -1
    place = np.searchsorted(keys, own)
    hit, known = ends[place] == own, hi > lo
    sizes = np.fromiter(map(len, seen), np.int64, len(seen)) // 2
    row = np.repeat(np.arange(len(grams)), sizes)
    excluded = context[row] << BITS | np.frombuffer(b"".join(seen), np.uint16)
    at = np.searchsorted(keys, excluded)
    gone = np.bincount(row, np.where(ends[at] == excluded, np.append(n, 0)[at], 0), len(grams))
    rest, new_kinds = below[hi] - below[lo] - gone, hi - lo - sizes
    logs = logs.copy()
    logs[hit] += np.log10((n[place[hit]] - 0.5) / rest[hit])
    leave = known & ~hit & (new_kinds > 0)
    logs[leave] += np.log10(0.5 * new_kinds[leave] / rest[leave])
    symbols = (keys & mask(1)).astype(np.uint16).tobytes()
    return hit, logs, [symbols[2 * a: 2 * b] for a, b in zip(lo.tolist(), hi.tolist())]


OPEN = "bucket int, gram long, log double, seen binary, hit boolean, at int"


def open_logs(table: DataFrame, order: int, buckets: int) -> DataFrame:
    """``bucket, gram, log``: log10 of the probability of the last symbol of each gram that no training text has.

    ``table``: ``bucket, grams, n`` of the longest grams. Such a gram escapes order by order, as ``Trie.log10`` does in memory, and
    takes along which symbols to exclude; it meets the table of an order by the bucket of its context there. The two shortest
    orders have at most 258 * 257 grams, whatever the texts, and few contexts to deal by, so they go along with the tasks.
    """
    spark = table.sparkSession

    def rows(bucket, grams: np.ndarray, keys: np.ndarray, n: np.ndarray, k: int, logs: np.ndarray, seen: list[bytes]) -> pd.DataFrame:
        hit, logs, seen = escaped(keys, n, k, grams, logs, seen)
        return pd.DataFrame({"bucket": bucket, "gram": grams, "log": logs, "seen": seen, "hit": hit, "at": bucket_of(grams & mask(k), buckets)})

    def longest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bucket, grams, n in zip(batch["bucket"], batch["grams"], batch["n"]):
                every = restored_keys(grams)
                new = every[restored(n, np.int64) == 0]
                if len(new):
                    yield rows(bucket, new, *trained(grams, n), order, np.zeros(len(new)), [b""] * len(new))

    def next_order(k: int):
        def run(asking: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
            none = np.zeros(0, np.int64)
            keys, n = trained(values["grams"].iat[0], values["n"].iat[0]) if len(values) else (none, none)
            return rows(asking["bucket"].to_numpy(), asking["gram"].to_numpy(), keys, n, k, asking["log"].to_numpy(), list(asking["seen"]))
        return run

    open_, done = written(table.mapInPandas(longest, OPEN), "escapes"), []
    for k in range(order - 1, 0, -1):
        table = written(shorter_grams(table, k + 1, buckets), "grams")
        if k > 1:
            done.append(open_.filter("hit").select("bucket", "gram", "log"))
            own = open_.filter("NOT hit").select("bucket", "gram", "log", "seen", "at")
            asked = table.join(own.select(F.col("at").alias("bucket")).distinct(), "bucket", "left_semi")
            open_ = written(own.groupBy("at").cogroup(asked.groupBy("bucket")).applyInPandas(next_order(k), OPEN), "escapes")
    done.append(open_.filter("hit").select("bucket", "gram", "log"))
    found = table.select("grams", "n").toPandas()
    pairs, n = merged_counts(*map(list, zip(*[trained(g, c) for g, c in zip(found["grams"], found["n"])])) if len(found) else ([], []))
    last = [(1, pairs, n)] if order > 1 else []
    if order:
        last.append((0, *merged_counts([pairs & mask(1)], [n])))

    def shortest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bucket, grams, logs, seen = batch["bucket"].to_numpy(), batch["gram"].to_numpy(), batch["log"].to_numpy(), list(batch["seen"])
            for k, keys, n in last:
                hit, logs, seen_here = escaped(keys, n, k, grams, logs, seen)
                yield pd.DataFrame({"bucket": bucket[hit], "gram": grams[hit], "log": logs[hit]})
                bucket, grams, logs, seen = bucket[~hit], grams[~hit], logs[~hit], [s for s, h in zip(seen_here, hit) if not h]
            left = SYMBOLS - np.fromiter(map(len, seen), np.int64, len(seen)) // 2
            yield pd.DataFrame({"bucket": bucket, "gram": grams, "log": logs - np.log10(left)})

    found = open_.filter("NOT hit").mapInPandas(shortest, "bucket int, gram long, log double")
    for d in done:
        found = found.unionByName(d)
    return found


def log_values(keys: np.ndarray, n: np.ndarray, totals: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Logs of sorted grams from their counts, the totals of their contexts, and the ``logs`` of those that training has not."""
    context = keys >> BITS
    total = totals[np.cumsum(np.concatenate(([True], context[1:] != context[:-1]))) - 1]
    out = np.empty(len(keys))
    out[n > 0] = np.log10((n[n > 0] - 0.5) / total[n > 0])
    out[n == 0] = logs
    return out


def learn_logs(chunks: DataFrame, order: int, buckets: int) -> DataFrame:
    """``chunk, bucket, n, totals, logs`` of the distinct grams of each chunk, in the order of their keys, as ``log_values`` takes them."""
    spark = chunks.sparkSession
    own = written(chunk_grams(chunks, order, buckets), "own")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [group["bucket"].iat[0]], "logs": [squeezed(group.sort_values("gram")["log"].to_numpy())]})

    def look_up(asking: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        keys, n = restored_keys(values["grams"].iat[0]), restored(values["n"].iat[0], np.int64)
        new, logs = values["logs"].iat[0], np.zeros(len(keys))
        if new is not None:
            logs[n == 0] = restored(new, np.float64)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] >> BITS != keys[:-1] >> BITS)))
        total = np.repeat(np.add.reduceat(n, first), np.diff(np.append(first, len(keys))))
        out = []
        for chunk, grams in zip(asking["chunk"], asking["grams"]):
            grams = restored_keys(grams)
            at = np.searchsorted(keys, grams)
            change = np.concatenate(([True], grams[1:] >> BITS != grams[:-1] >> BITS))
            out.append((chunk, values["bucket"].iat[0], squeezed(n[at]), squeezed(total[at[change]]), squeezed(logs[at[n[at] == 0]])))
        return pd.DataFrame(out, columns=["chunk", "bucket", "n", "totals", "logs"])

    bounded_batches(spark, 100_000)
    table = written(merged_blocks(own), "grams")
    new = open_logs(table, order, buckets).groupBy("bucket").applyInPandas(pack, "bucket int, logs binary")
    values = written(table.join(new, "bucket", "left"), "logs")
    return own.drop("n").groupBy("bucket").cogroup(values.groupBy("bucket")).applyInPandas(
        look_up, "chunk long, bucket int, n binary, totals binary, logs binary")


def score_chunk(texts: list[bytes], order: int, buckets: int, found: dict[int, tuple[bytes, bytes, bytes]]) -> np.ndarray:
    """log10 probabilities of whole texts, from what ``learn_logs`` found for their distinct grams by bucket."""
    slices = []
    for part in in_slices(texts):
        keys, sizes = gram_keys(part, order)
        distinct, inverse = np.unique(keys, return_inverse=True)
        slices.append((distinct, inverse.astype(np.int32), sizes))
    every = np.unique(np.concatenate([s[0] for s in slices]))
    values = np.empty(len(every))
    for b, places in zip(*by_bucket(bucket_of(every, buckets))):
        n, totals, logs = found[b]
        values[places] = log_values(every[places], restored(n, np.int64), restored(totals, np.int64), restored(logs, np.float64))
    out = []
    for distinct, inverse, sizes in slices:
        out.append(np.add.reduceat(values[np.searchsorted(every, distinct)][inverse], np.cumsum(sizes) - sizes))
    return np.concatenate(out)


def score_texts(docs: DataFrame, held_out: Column, order: int = 5, chunk_bytes: int = 8_000_000, bucket_bytes: int = 16_000_000,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows whose ``held_out`` is not true. ``score`` is the log10 probability of the whole
    text under the byte model, ``base_score`` that of its words and end under unigrams with one added. A null text counts as
    empty: its end alone. Repeated rows count and are scored each. With no training rows
    scores are those of uniform symbols. An empty table gives no rows.
    """
    spark = docs.sparkSession
    chunks = written(chunked(docs, id_col, text_col, F.coalesce(held_out, F.lit(False)), chunk_bytes), "chunks")
    size, texts = chunks.select(
        F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n).alias("size"),
        F.aggregate("held_out", F.lit(0), lambda a, h: a + F.when(h, 0).otherwise(1)).alias("n")).agg(F.sum("size"), F.sum("n")).first()
    texts, buckets = texts or 0, max(1, -(-(size or 0) // bucket_bytes))
    counts = written(word_counts(chunks, buckets), "words")
    tokens, kinds = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    tokens, kinds = tokens + texts, kinds + (texts > 0)
    logs = learn_logs(chunks, order, buckets)
    logs = logs.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "totals", "logs")).alias("logs"))
    known = counts.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "c")).alias("counts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                texts_here = unpacked(row.texts, row.sizes)
                own, words, bucket = word_numbers(texts_here, buckets)
                c = np.zeros(len(words), np.int64)
                if row.counts is not None:
                    of = {x["bucket"]: x["c"] for x in row.counts}
                    for b, places in zip(*by_bucket(bucket)):
                        c[places] = restored(of[b], np.int64)
                logs = np.log10((c + 1) / (tokens + kinds + 1))
                end = np.log10((texts + 1) / (tokens + kinds + 1))
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(i) else int(i) for i in row.doc_ids], "Int64"), "held_out": list(row.held_out),
                    "n_tokens": [len(o) + 1 for o in own], "n_known": [int((c[o] > 0).sum()) + (texts > 0) for o in own],
                    "train_tokens": tokens, "base_score": [float(logs[o].sum() + end) for o in own],
                    "score": score_chunk(texts_here, order, buckets, {x["bucket"]: (x["n"], x["totals"], x["logs"]) for x in row.logs})})

    bounded_batches(spark, 1)
    return chunks.join(known, "chunk", "left").join(logs, "chunk").select(
        "doc_ids", "held_out", "sizes", "texts", "counts", "logs").mapInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
