"""Periodic runs of words by dyadic square catching.

A catcher sits on every completed block of a power of two of words, ``l`` words from a multiple of ``l``. It waits for its block to come
again ``p`` words later, ``2l - 1 <= p <= 4l - 2``: these spans part all periods among the block lengths, and a square
of period ``p`` holds a whole block of that length in its first half, so no square passes every catcher. A catcher that
has seen its block compares on, to the right with each word that is appended and to the left with what stood before the block; once
``p`` words in a row are equal a square has closed, and squares of one period that touch are one run.

The words of a slice of texts are appended together: what the arrival of word ``j`` does at the catchers of one block length is
one row of an array comparison. Equal blocks have equal names: a block's name is the number of the pair of its halves' names, so
comparisons are exact and any of them takes one look-up a block length. Texts in which no block of some length
comes twice hold no longer squares and leave the slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 200_000  # words appended together, unless one text alone has more
RUNS = "array<struct<start:long,length:long,period:long>>"


def _caught(names: list[np.ndarray], level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, period``: chains of neighbouring blocks of ``2 ** level`` words that come again ``period`` words later."""
    size, here = 1 << level, names[level]
    blocks = np.full(-(-len(here) // size) * size, -1, here.dtype)
    blocks[: len(here)] = here
    blocks = blocks.reshape(-1, size)
    found = []
    for ahead, lo, hi in ((1, size - 1, size), (2, 0, size), (3, 0, size - 1)):
        if len(blocks) > ahead and lo < hi:
            block, at = np.nonzero(blocks[ahead:, lo:hi] == blocks[:-ahead, :1])
            found.append((block * size, ahead * size + lo + at))
    if not any(len(b) for b, _ in found):
        return (np.zeros(0, np.int64),) * 3
    start, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + size)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first], start[last] + size, period[first]


def _extended(names: list[np.ndarray], level: int, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compares on from both ends of the chains. Less than a block is left on each side, or the next block had matched."""
    first, last, total = first.copy(), last.copy(), len(names[0])
    for k in range(level - 1, -1, -1):
        step = 1 << k
        at = np.maximum(first - step, 0)
        first -= np.where((first >= step) & (names[k][at] == names[k][at + period]), step, 0)
        at = np.minimum(last, total - 1 - period)
        last += np.where((last + period + step <= total) & (names[k][at] == names[k][at + period]), step, 0)
    return first, last


def find_runs(texts: list[np.ndarray], least: int = 12) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of every run in arrays of word numbers, by text, start and period.

    A run is a stretch with smallest period ``q`` that is not part of a longer one of that period and has ``max(least, 2 * q)`` words or more.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    texts_of = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(texts_of)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
    ends = np.flatnonzero(place == sizes[texts_of])
    words = np.empty(len(texts_of), np.int64)
    inner = np.ones(len(words), bool)
    inner[ends] = False
    words[inner] = np.concatenate([*texts, np.zeros(0, np.int64)])
    # Names differ from text to text, and each text ends with a name of its own, so nothing matches across texts.
    keys = words + (texts_of.astype(np.int64) << 32)
    keys[ends] = -1 - np.arange(len(ends))
    names, found = [pd.factorize(keys)[0].astype(np.int32)], []
    while len(names[0]):
        level = len(names) - 1
        # Texts without a block that comes twice leave the slice once they hold most of its words.
        again = np.bincount(names[level])[names[level]] > 1
        alive = np.bincount(texts_of, again, minlength=len(texts)) > 0
        keep = alive[texts_of]
        if 2 * keep.sum() < len(keep):
            names, texts_of, place = [n[keep] for n in names], texts_of[keep], place[keep]
            if not len(texts_of):
                break
        first, last, period = _caught(names, level)
        first, last = _extended(names, level, first, last, period)
        square = (last - first >= period) & (last - first + period >= least)
        first, last, period = first[square], last[square], period[square]
        found.append((texts_of[first], place[first], last - first + period, period))
        size, here = 1 << level, names[level]
        if 4 * size > sizes.max():  # the next blocks' shortest period does not fit twice
            break
        later = np.zeros_like(here)
        later[: max(0, len(here) - size)] = here[size:]
        names.append(pd.factorize((here.astype(np.int64) << 32) | later)[0].astype(np.int32))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    text, start, length, period = (np.concatenate(c) for c in zip(*found))
    # A multiple of a run's period gives the same stretch again: the smallest period of a stretch is its own.
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    own = np.ones(len(text), bool)
    own[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[own], start[own], length[own], period[own]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words, joined by spaces, without those of a run after its first period."""
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def _batch(texts: pa.Array, least: int) -> pa.Array:
    runs, text_out, words, size = [], [], [], 0

    def flush() -> None:
        codes = pd.factorize(np.array([w for ws in words for w in ws] or [b""], object))[0]
        cuts = np.cumsum([0, *map(len, words)])
        text, start, length, period = find_runs([codes[a:b] for a, b in zip(cuts[:-1], cuts[1:])], least)
        bounds = np.searchsorted(text, np.arange(len(words) + 1))
        for ws, a, b in zip(words, bounds[:-1], bounds[1:]):
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())])
            text_out.append(collapsed(ws, start[a:b], length[a:b], period[a:b]).decode("utf-8", "replace"))
        words.clear()

    for t in texts:
        words.append((t.as_py() or "").encode("utf-8", "replace").split())
        size += len(words[-1])
        if size > SLICE:
            flush()
            size = 0
    if words:
        flush()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.StructArray.from_arrays([pa.array(runs, kind), pa.array(text_out, pa.string())], names=["runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12) -> DataFrame:
    """``doc_id, runs, collapsed`` per row of ``docs``.

    Words are runs of anything but ASCII white space, numbered from 0. ``runs`` lists ``start, length, period`` by start and
    period of every run of at least ``least`` words; ``collapsed`` is the text's words joined by one space without those that repeat an
    earlier period of a run. Null texts and those without words have no runs and collapse to the empty text. Every row is answered on its own, so
    null and repeated ids keep their rows; other columns are left out; an empty table gives no rows. A task holds about ``8 * log2(n)``
    bytes a word of a slice, or of one text that is longer than a slice.
    """

    @F.arrow_udf(f"struct<runs:{RUNS},collapsed:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _batch(texts, least)

    return docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("_r")).select("doc_id", "_r.*")
