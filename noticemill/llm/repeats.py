"""Repeated byte strings removed by way of a collection's suffix order, built column by column.

Every window of ``length`` bytes belongs to the least hash of the short grams within it. Windows in a row with the
same least hash make a *piece*; equal windows have equal least hashes, so repeats can only be found among
pieces of one hash, and Spark deals pieces out by it, in compressed blocks. Windows also share a longer string about that gram, their
core; those whose core occurs once are left out by a filter of fixed size, and of equal pieces only the earliest goes on: later ones are repeats as a whole.

Within a bucket the pieces are the documents of a collection whose Burrows-Wheeler transform is built by adding one symbol
of each per round, from the gram of their hash to the left, together with the common prefixes of neighbours; what follows is sorted first. Transform, prefixes
and owners are sequential files that every round reads and rewrites once in order; a bucket is of
bounded size, so they are held as arrays. Neighbours with a common prefix of ``length`` or more are equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches, written
from noticemill.llm.lm_scoring import by_bucket, merged_counts, restored, restored_keys, squeezed, squeezed_keys
from noticemill.llm.near_dedup import GOLDEN, mixed

GRAM = 32  # bytes of a short gram, a power of two
MOST_WINDOWS = 64  # of a piece; a longer run of windows is cut, as every round costs a pass over the bucket
CORES = 3  # strings in which the windows of a place are counted
SEGMENT = 1 << 20  # windows of a text that are looked at together
SLICE = 1 << 15  # bytes of short texts that are looked at together: small arrays stay near the processor
SLOT = 32  # leading bits of a hash by which the occurrences are counted
PARTS = 8  # of these bits, those that deal slots out for counting
COLLECTION = 2000  # pieces whose transform is built at once, for the same reason
HELD = 64 << 20  # bytes of pieces that a task deals out at once


# --- pieces ---------------------------------------------------------------------------------------

def _running(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[: len(x) - (width - size)], x[width - size:]) if size < width else x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on."""
    return np.concatenate([_hashes(data[a: a + SLICE + GRAM - 1]) for a in range(0, len(data) - GRAM + 1, SLICE)] or [np.zeros(0, np.uint64)])


def _hashes(data: np.ndarray) -> np.ndarray:
    h, size = mixed(data.astype(np.uint64) * GOLDEN + GOLDEN), 1
    while size < GRAM:
        h = h[:-size] * np.uint64(0xD6E8FEB86659FD93 + 2 * size) ^ (h[size:] + (h[size:] >> np.uint64(29)))
        size *= 2
    return mixed(h)


def slices(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts joined in slices: gram hashes, least hash per window and whether the window lies in one text; starts in the slice, text numbers, starts in the text.

    Parts of ``SEGMENT`` windows of a text are looked at together, and short texts; a window is in one part.
    """
    part, held = [], 0
    for number, data in enumerate(texts):
        for start in range(0, len(data) - length + 1, SEGMENT):
            part.append((number, start, data[start: start + SEGMENT + length - 1]))
            held += len(part[-1][2])
            if held >= SLICE:
                yield _slice(part, length)
                part, held = [], 0
    if part:
        yield _slice(part, length)


def _slice(part: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    h = gram_hashes(np.frombuffer(b"".join(p[2] for p in part), np.uint8))
    least = _running(np.minimum, h, length - GRAM + 1)
    ends = np.cumsum([len(p[2]) for p in part])
    valid = np.ones(len(least), bool)
    valid[((ends[:-1] - length + 1)[:, None] + np.arange(length - 1)).ravel()] = False
    return h, least, valid, np.append(0, ends[:-1]), np.array([p[0] for p in part]), np.array([p[1] for p in part])


def least_places(h: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """Places whose hash is the least of some window."""
    width = length - GRAM + 1
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(h == _running(np.maximum, padded, width))


def cores(h: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the bytes that the windows of a place share, by how far before it they start: ``CORES`` in a row for each place.

    Cores that leave their text mean nothing, and no window has them.
    """
    step = (length - GRAM + 1) // CORES
    out = np.empty((len(places), CORES), np.uint64)
    for c in range(CORES):
        own = mixed(np.full(len(places), c, np.uint64))
        for k in range(CORES):
            own = mixed(own * np.uint64(0xD6E8FEB86659FD93) ^ h[np.clip(places + (k - c) * step, 0, len(h) - 1)])
        out[:, c] = own
    return out


def pieces(texts: list[bytes], length: int, wanted) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hash, text number, start and number of windows of the pieces: runs of windows whose core is ``wanted``, given hashes and cores of places."""
    step = (length - GRAM + 1) // CORES
    for h, least, valid, first, number, offset in slices(texts, length):
        places = least_places(h, np.where(valid, least, np.uint64(0)), length)
        mark = wanted(h[places], cores(h, places, length))
        # Each window belongs to the first place of its least hash.
        window = np.flatnonzero(valid)
        at = np.searchsorted(places, window)
        off = np.flatnonzero(h[places[at]] != least[window])
        while len(off):
            at[off] += 1
            off = off[h[places[at[off]]] != least[window[off]]]
        keep = np.zeros(len(least), bool)
        keep[window] = mark[at, np.minimum((places[at] - window) // step, CORES - 1)]
        # The last window of a part and the first of the next are never neighbours.
        cut = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (keep[1:] != keep[:-1]))))
        runs = np.diff(np.append(cut, len(least)))
        cut, runs = cut[keep[cut]], runs[keep[cut]]
        parts = -(-runs // MOST_WINDOWS)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(cut, parts) + nth * MOST_WINDOWS
        at = np.searchsorted(first, start, "right") - 1
        yield least[start], number[at], start - first[at] + offset[at], np.minimum(np.repeat(runs, parts) - nth * MOST_WINDOWS, MOST_WINDOWS)


# --- the collection -------------------------------------------------------------------------------

def column_wise(texts: list[bytes], length: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the texts in order and the common prefix of each with the one before, at most ``length``.

    Suffixes are numbered by the place they start at in the texts joined with one byte between; ends of texts
    come first in order. One symbol of each text is added per round, from its end on. Where the texts go on
    after their ends and are sorted by that, ``common`` is what these tails share with the one before.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    n = len(texts)
    is_end = np.zeros(len(joined), bool)
    is_end[ends] = True
    # What stands before a suffix; +1 so that 0 can stand for the beginning of a text. UTF-8 has no byte 255.
    kind = np.uint8 if joined.max() < 255 else np.int16
    symbol_at = (joined.astype(np.int16) + 1).astype(kind)
    bwt = np.where(sizes > 0, symbol_at[ends - 1], 0).astype(kind)
    prefix, owner = np.zeros(n, np.uint8) if common is None else common.astype(np.uint8), ends.astype(np.int32)
    is_added = bwt > 0  # of the suffixes that the next symbol extends
    while is_added.any():
        # A suffix is extended to the rank of its symbol among all; ends of texts stand before.
        counts = np.bincount(bwt, minlength=2)
        by_symbol = np.argsort(bwt, kind="stable")[counts[0]:]
        limits = np.cumsum(counts[1:])
        own = np.flatnonzero(is_added[by_symbol])
        new = n + own
        touched = np.zeros(len(by_symbol) + 1, bool)
        touched[own], touched[own + 1] = True, True
        after = np.flatnonzero(touched[:-1])
        symbol = np.searchsorted(limits, after, "right")
        # Common prefix with the neighbour of the same symbol: one more than the least on the way from it.
        fresh = np.zeros(len(after), np.uint8)
        inner = np.flatnonzero(after > np.append(0, limits)[symbol])
        if len(inner):
            r = after[inner]
            ways = np.empty(2 * len(r), np.int64)
            ways[0::2], ways[1::2] = by_symbol[r - 1] + 1, by_symbol[r] + 1
            ended = np.append(prefix, np.uint8(0))
            for lo, hi in blocks(symbol[inner]):  # within a symbol the ways lie in order
                fresh[inner[lo:hi]] = np.minimum(np.minimum.reduceat(ended, ways[2 * lo: 2 * hi])[0::2], length - 1) + 1
        # The sequential rewrite: old entries keep their order, new ones are put between.
        total = len(bwt) + len(new)
        old = np.ones(total, bool)
        old[new] = False
        start = owner[by_symbol[own]] - 1
        grown_bwt, grown_prefix, grown_owner = np.empty(total, kind), np.empty(total, np.uint8), np.empty(total, np.int32)
        grown_bwt[old], grown_prefix[old], grown_owner[old] = bwt, prefix, owner
        at_beginning = (start == 0) | is_end[start - 1]
        grown_owner[new] = start
        grown_bwt[new] = np.where(at_beginning, 0, symbol_at[start - 1])
        grown_prefix[n + after] = fresh
        bwt, prefix, owner = grown_bwt, grown_prefix, grown_owner
        is_added = np.zeros(total, bool)
        is_added[new[~at_beginning]] = True
    return owner, prefix


def blocks(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    yield from zip(cut[:-1].tolist(), cut[1:].tolist())


def gram_places(texts: list[bytes], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place of every occurrence of each text's own gram hash, in order."""
    ends = np.cumsum([len(t) for t in texts])
    starts = np.append(0, ends[:-1])
    h = gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
    at = np.flatnonzero(h == np.repeat(grams, np.diff(np.append(0, ends)))[: len(h)])
    text = np.searchsorted(ends, at, "right")
    inside = at + GRAM <= ends[text]
    return text[inside], (at - starts[text])[inside]


def shared_bytes(tails: list[bytes], length: int) -> np.ndarray:
    """Common prefix of each of the sorted tails with the one before, at most ``length``."""
    sizes = np.minimum([len(t) for t in tails], length)
    rows = np.frombuffer(b"".join(t[:length].ljust(length, b"\0") for t in tails), np.uint8).reshape(-1, length)
    unlike = np.ones((len(tails), length + 1), bool)
    unlike[1:, :length] = rows[1:] != rows[:-1]
    return np.where(np.arange(len(tails)) > 0, np.minimum(unlike.argmax(1), np.minimum(sizes, np.roll(sizes, 1))), 0)


def repeated_windows(texts: list[bytes], place: np.ndarray, grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows that also start earlier: text numbers and sorted starts.

    ``place`` has two columns: the rank of the text's document, and where in it the text starts. ``grams`` are the hashes of
    which every window has one. Windows with the same first place of it are a collection's text: what stands
    before that place is added column by column, what follows is sorted first. Equal windows agree in both.
    """
    t, p = gram_places(texts, grams)
    windows = np.array([len(x) for x in texts])[t] - length + 1
    low = np.where(np.concatenate(([True], t[1:] != t[:-1])), 0, np.append(0, p[:-1]) + 1)
    high = np.minimum(p, windows - 1)
    t, p, low, high = (x[low <= high] for x in (t, p, low, high))
    tails = [texts[i][a: b + length] for i, a, b in zip(t.tolist(), p.tolist(), high.tolist())]
    order = np.array(sorted(range(len(tails)), key=tails.__getitem__), np.int64)
    t, p, low, high = t[order], p[order], low[order], high[order]
    owner, prefix = column_wise([texts[i][a:b] for i, a, b in zip(t.tolist(), low.tolist(), p.tolist())], length, shared_bytes([tails[i] for i in order], length))
    starts = np.cumsum(np.append(0, p - low + 1))
    text = np.searchsorted(starts, owner, "right") - 1
    offset = low[text] + owner - starts[text]
    whole = offset <= high[text]
    same = (prefix >= length) & whole
    group = np.cumsum(~same)
    held = np.flatnonzero(whole)
    text = t[text[held]]
    g, document, start = group[held], place[text, 0], place[text, 1] + offset[held]
    by_place = np.lexsort((start, document, g))
    held, g, document, start, text = held[by_place], g[by_place], document[by_place], start[by_place], text[by_place]
    first = np.concatenate(([True], g[1:] != g[:-1]))
    lead = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    # A window at the very place of the first is the same window, held by two pieces of a cut run or a repeated row.
    later = (document != document[lead]) | (start != start[lead])
    t, o = text[later], offset[held[later]]
    order = np.lexsort((o, t))
    return t[order], o[order]


def spans(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal runs of bytes that windows cover: text number, start, end. Windows are sorted by text and start."""
    cut = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (starts[1:] > starts[:-1] + length)))[: len(starts)])
    return text[cut], starts[cut], starts[np.append(cut[1:] - 1, len(starts) - 1)[: len(cut)]] + length


# --- a bucket -------------------------------------------------------------------------------------

BLOCK = ("pieces", "sizes", "grams", "copies", "row_ids", "row_hashes", "starts")


def dealt(found: list[tuple], buckets: int) -> pd.DataFrame:
    """Pieces in a block a bucket: different ones once, with the places of their copies. ``found``: gram, row id, row hash, start, bytes."""
    numbers: dict[bytes, int] = {}
    which = np.fromiter((numbers.setdefault(x, len(numbers)) for f in found for x in f[4]), np.int64)
    gram, row_id, row_hash, start = (np.concatenate([f[i] for f in found]) for i in range(4))
    content, grams = list(numbers), np.empty(len(numbers), np.uint64)
    grams[which] = gram
    rank = np.empty(len(numbers), np.int64)
    # Equal hashes side by side, as their pieces share bytes.
    by_gram = np.argsort(grams, kind="stable")
    rank[by_gram] = np.arange(len(by_gram))
    order = np.lexsort((start, row_id, rank[which]))
    which, row_id, row_hash, start = rank[which][order], row_id[order], row_hash[order], start[order]
    grams, content = grams[by_gram], [content[i] for i in by_gram.tolist()]
    own = (mixed(grams ^ GOLDEN) % np.uint64(buckets)).astype(np.int64)
    out = []
    for (bucket, at), (_, copies) in zip(zip(*by_bucket(own)), zip(*by_bucket(own[which]))):
        parts = [content[i] for i in at.tolist()]
        out.append((bucket, zstandard.compress(b"".join(parts), 3), squeezed(np.array([len(x) for x in parts], np.int64)), squeezed(grams[at]),
                    squeezed_keys(np.searchsorted(at, which[copies])), *(squeezed(x[copies]) for x in (row_id, row_hash, start))))
    return pd.DataFrame(out, columns=["bucket", *BLOCK])


def repeats_of(blocks: pd.DataFrame, length: int) -> pd.DataFrame:
    """``row_id, row_hash, a, b``: bytes that repeat earlier ones, as far as the pieces of a bucket tell.

    Of equal pieces the first stays; the transform is built of the different pieces of each hash.
    """
    numbers: dict[bytes, int] = {}
    which, every = [], []
    for _, block in blocks.iterrows():
        ends = np.cumsum(restored(block["sizes"], np.int64))
        data = zstandard.decompress(block["pieces"])
        own = np.fromiter((numbers.setdefault(data[a:b], len(numbers)) for a, b in zip([0, *ends.tolist()], ends.tolist())), np.int64, len(ends))
        which.append(own[restored_keys(block["copies"])])
        every.append((own, restored(block["grams"], np.uint64), *(restored(block[c], np.int64) for c in ("row_ids", "row_hashes", "starts"))))
    which, (own, gram, row_id, row_hash, start) = np.concatenate(which), (np.concatenate(x) for x in zip(*every))
    content, grams = list(numbers), np.empty(len(numbers), np.uint64)
    grams[own] = gram
    sizes = np.array([len(x) for x in content])
    order = np.lexsort((start, row_hash, row_id, which))
    which, row_id, row_hash, start = which[order], row_id[order], row_hash[order], start[order]
    first = np.concatenate(([True], which[1:] != which[:-1]))
    at = np.flatnonzero(first)  # by piece, as every number occurs
    later = (row_id != row_id[at][which]) | (row_hash != row_hash[at][which]) | (start != start[at][which])
    out = [(row_id[later], row_hash[later], start[later], start[later] + sizes[which[later]])]
    # A hash with one piece, within which it does not occur twice, has no other repeats.
    _, number, kinds = np.unique(grams, return_inverse=True, return_counts=True)
    occurs = np.bincount(gram_places(content, grams)[0], minlength=len(content))
    open_ = np.flatnonzero((kinds[number] > 1) | (occurs > 1))
    row_id, row_hash, start = row_id[at], row_hash[at], start[at]
    open_ = open_[np.argsort(number[open_], kind="stable")]
    # Collections of whole hashes.
    whole = np.flatnonzero(np.concatenate(([True], number[open_][1:] != number[open_][:-1]))[: len(open_)])
    cuts = whole[np.flatnonzero(np.diff(whole // COLLECTION, prepend=-1))]
    for part in np.split(open_, cuts[1:]) if len(open_) else []:
        part = part[np.lexsort((start[part], row_hash[part], row_id[part]))]
        same = (row_id[part][1:] == row_id[part][:-1]) & (row_hash[part][1:] == row_hash[part][:-1])
        document = np.cumsum(np.concatenate(([True], ~same)))
        text, a, b = spans(*repeated_windows([content[i] for i in part.tolist()], np.stack((document, start[part]), 1), grams[part], length), length)
        text = part[text]
        out.append((row_id[text], row_hash[text], start[text] + a, start[text] + b))
    return pd.DataFrame(dict(zip(("row_id", "row_hash", "a", "b"), (np.concatenate(x) for x in zip(*out)))))


# --- the job --------------------------------------------------------------------------------------

def hot_repeats(long_rows: DataFrame, cut, length: int) -> DataFrame:
    """``row_id, row_hash, a, b`` for pieces of hashes that occur too often for a bucket: by content of pieces, then of their windows.

    The joins merge: Spark knows the size of the files with the pieces, not of the windows cut from them, and what it
    took for small enough to broadcast would pass through the driver.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row_id, row_hash, start, own in cut(batch):
                yield pd.DataFrame({"row_id": row_id, "row_hash": row_hash, "start": start, "bytes": own})

    every = long_rows.select("row_id", "row_hash", "data").mapInPandas(run, "row_id long, row_hash long, start long, bytes binary").withColumn(
        "key", F.sha2("bytes", 256))
    place = F.struct("row_id", "row_hash", "start")
    firsts = written(every.groupBy("key").agg(F.min(place).alias("place"), F.any_value("bytes").alias("bytes")).select("key", "place.*", "bytes"), "pieces")
    later = every.withColumn("b", F.col("start") + F.length("bytes")).drop("bytes").alias("p").join(
        firsts.select("key", "row_id", "row_hash", "start").hint("merge").alias("f"), "key").filter(
        "p.row_id <> f.row_id OR p.row_hash <> f.row_hash OR p.start <> f.start").select("p.row_id", "p.row_hash", F.col("p.start").alias("a"), "b")
    window = F.explode(F.sequence(F.lit(0), F.length("bytes") - length))
    single = firsts.select("row_id", "row_hash", "start", "bytes", window.alias("o")).select(
        F.sha2(F.expr(f"substring(bytes, o + 1, {length})"), 256).alias("window"), "row_id", "row_hash", (F.col("start") + F.col("o")).alias("start"))
    # Written, so that both sides of the join come straight from a shuffle: a window of very many pieces can then be split.
    earliest = written(single.groupBy("window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "windows")
    hot = single.join(earliest.hint("merge"), "window").filter(
        "row_id <> first.row_id OR row_hash <> first.row_hash OR start <> first.start").select(
        "row_id", "row_hash", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    return later.unionByName(hot)


def remove_repeats(docs: DataFrame, length: int = 100, filter_bits: int = 27, bucket_bytes: int = 4_000_000, hot_pieces: int = 100_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that are left).

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a document of smaller id or earlier in
    the same one. Strings are judged on the input. A null text counts as empty; texts shorter than ``length`` stay whole.
    Rows of one id are ordered by a hash of their text; rows that repeat id and text are the same document,
    so they are judged alike and neither is a repeat of the other. A null id comes last. Empty table: no rows.

    ``filter_bits``: size of the filter that is sent to all tasks (2 ** 27 bits are 16 MB); when it fills up more
    pieces travel, with the same result. ``bucket_bytes``: of text for each bucket of pieces. ``hot_pieces``: pieces of a hash that occurs
    more often are cut into windows, which are grouped by content instead, so none fills a bucket.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 1000)
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("row_id"),
        F.xxhash64(text).alias("row_hash"), text.alias("data"))
    long_rows = rows.filter(F.length("data") >= length)
    slot_of = lambda h: h >> np.uint64(64 - SLOT)

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def block(found: list[np.ndarray], size: int) -> pd.DataFrame:
            slots, n = np.unique(np.concatenate(found), return_counts=True)
            numbers, parts = by_bucket(slots >> np.uint64(SLOT - PARTS))
            return pd.DataFrame({"part": numbers, "slots": [squeezed_keys(slots[p].astype(np.int64)) for p in parts],
                                 "n": [squeezed(n[p].astype(np.int64)) for p in parts], "size": [size] + [0] * (len(parts) - 1)})

        found, size, held = [], 0, 0
        for batch in batches:
            for h, low, valid, *_ in slices(list(batch["data"]), length):
                places = least_places(h, np.where(valid, low, np.uint64(0)), length)
                found += [slot_of(h[places]), slot_of(cores(h, places, length).ravel())]
                held += len(places)
            size += int(batch["data"].str.len().sum())
            if held > 1 << 20:
                yield block(found, size)
                found, size, held = [], 0, 0
        if found:
            yield block(found, size)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        slots, n = merged_counts([restored_keys(x) for x in group["slots"]], [restored(x, np.int64) for x in group["n"]])
        part, bits = int(group["part"].iat[0]), np.zeros(1 << (filter_bits - PARTS), bool)
        bits[(slots[n > 1] >> (SLOT - filter_bits)) - (part << (filter_bits - PARTS))] = True
        return pd.DataFrame({"part": [part], "bits": [zstandard.compress(np.packbits(bits, bitorder="little").tobytes(), 3)],
                             "hot": [slots[n > hot_pieces].tolist()], "size": [int(group["size"].sum())]})

    counted = long_rows.select("data").mapInPandas(least, "part int, slots binary, n binary, size long").groupBy("part").applyInPandas(
        count, "part int, bits binary, hot array<long>, size long").collect()
    table = np.zeros((1 << PARTS, 1 << (filter_bits - PARTS - 3)), np.uint8)
    for r in counted:
        table[r["part"]] = np.frombuffer(zstandard.decompress(bytes(r["bits"])), np.uint8)
    hot_slots = np.array(sorted(x for r in counted for x in r["hot"]), np.uint64)
    buckets = max(1, -(-sum(r["size"] for r in counted) // bucket_bytes))
    seen = spark.sparkContext.broadcast(table.ravel())
    del table, counted

    def wanted(hot: bool):
        def test(gram: np.ndarray, core: np.ndarray) -> np.ndarray:
            at = slot_of(core) >> np.uint64(SLOT - filter_bits)
            found = (seen.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            return found & (np.isin(slot_of(gram), hot_slots) == hot)[:, None] if hot or len(hot_slots) else found
        return test

    def cut(batch: pd.DataFrame, hot: bool) -> Iterator[tuple]:
        data, row_id, row_hash = list(batch["data"]), batch["row_id"].to_numpy(), batch["row_hash"].to_numpy()
        for gram, number, start, n in pieces(data, length, wanted(hot)):
            own = [data[i][a: a + w + length - 1] for i, a, w in zip(number.tolist(), start.tolist(), n.tolist())]
            yield gram, row_id[number], row_hash[number], start, own

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, held = [], 0
        for batch in batches:
            for piece in cut(batch, False):
                if len(piece[0]):
                    found.append(piece)
                    held += sum(map(len, piece[4]))
                if held >= HELD:
                    yield dealt(found, buckets)
                    found, held = [], 0
        if found:
            yield dealt(found, buckets)

    blocks = long_rows.select("row_id", "row_hash", "data").mapInPandas(deal, "bucket int, " + ", ".join(f"{c} binary" for c in BLOCK))
    removed = blocks.groupBy("bucket").applyInPandas(lambda group: repeats_of(group, length), "row_id long, row_hash long, a long, b long")

    if len(hot_slots):
        removed = removed.unionByName(hot_repeats(long_rows, lambda batch: cut(batch, True), length))
    removed = removed.groupBy("row_id", "row_hash").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    removed = written(removed.select("row_id", "row_hash", F.sort_array("spans").alias("spans")), "spans")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, data, found in zip(batch["doc_id"], batch["data"], batch["spans"]):
                left, at, n_spans = [], 0, 0
                if found is not None:
                    reach = -1
                    for s in found:
                        a, b = s["a"], s["b"]
                        if a > reach:
                            n_spans += 1
                            left.append(data[at:a])
                        at = reach = max(reach, b)
                left.append(data[at:])
                kept = b"".join(left)
                out.append((doc_id, len(data), len(data) - len(kept), n_spans, kept, hashlib.sha256(kept).hexdigest()))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    # Merged too: files of spans that are alike are far smaller than the spans, which the driver would hold for a broadcast.
    joined = rows.join(removed.hint("merge"), ["row_id", "row_hash"], "left").select("doc_id", "data", "spans")
    return joined.mapInPandas(keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
