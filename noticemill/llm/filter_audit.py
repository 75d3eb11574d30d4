"""What a chain of filters removes in every order, from one table-driven pass over each text's bytes.

The transducer reads UTF-8 one byte a step. A table gives each byte its class, a second one the state and
the output of a step: a word opens, a word closes, a code point, a capital, a symbol. No state needs more than the
byte before, so the steps of a block of bytes are one look-up in the tables; the state at a block's end is carried into
the next block, and a word may run over any number of blocks. Each closed word's span goes into an open-addressing hash table with its text's
number: an equal hash only points at a span, and the bytes of both are compared before the word counts as seen.

All else is counting: a text becomes the set of filters it fails, rows are added up by set, and the 120 orders
are read off these sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
BLOCK = 1 << 18  # bytes of a step
SLICE = 1 << 22  # bytes whose words share a hash table, unless one text alone is longer

# --- the transducer: byte classes, states (0 gap, 1 word), outputs --------------------------------
GAP, CONTINUATION, CAPITAL, SYMBOL, OTHER = range(5)
CLASS_OF = np.full(256, OTHER, np.uint8)
CLASS_OF[[0x20, *range(0x09, 0x0E)]] = GAP
CLASS_OF[0x80:0xC0] = CONTINUATION
CLASS_OF[ord("A"):ord("Z") + 1] = CAPITAL
CLASS_OF[list(b"#$%&*|")] = SYMBOL
NEXT_STATE = np.array([[0, 1, 1, 1, 1]] * 2, np.uint8)
OPENS, CLOSES, POINT, UPPER, MARK = 1, 2, 4, 8, 16
OUTPUT = np.array([
    [POINT, OPENS, OPENS | POINT | UPPER, OPENS | POINT | MARK, OPENS | POINT],
    [CLOSES | POINT, 0, POINT | UPPER, POINT | MARK, POINT]], np.uint8)
STATE_AFTER = NEXT_STATE[0, CLASS_OF]  # both rows are equal: a step's state depends on its byte alone
OUTPUT_AFTER = [OUTPUT[s, CLASS_OF] for s in (0, 1)]

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS, INVERSES = _powers(BASE), _powers(INVERSE)


def _words(data: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs the transducer over ``data``, whose texts end (with a gap byte) at the places ``last``.

    Returns per text the counts of code points, capitals and symbols, and per word its start, end and hash.
    """
    points, upper, marks = (np.zeros(len(last), np.int64) for _ in range(3))
    starts, ends, before, undo, after = [], [], [], [], []
    state, carried = 0, np.uint64(0)
    for at in range(0, len(data), BLOCK):
        block = data[at: at + BLOCK]
        states = STATE_AFTER[block]
        previous = np.empty_like(states)
        previous[0], previous[1:] = state, states[:-1]
        out = np.where(previous, OUTPUT_AFTER[1][block], OUTPUT_AFTER[0][block])
        state = int(states[-1])
        # Sums of byte times power over all bytes so far give every span's hash by one subtraction.
        sums = np.cumsum((block.astype(np.uint64) + np.uint64(1)) * POWERS[: len(block)] * np.uint64(pow(BASE, at, 1 << 64)), dtype=np.uint64)
        opened, closed = np.flatnonzero(out & OPENS), np.flatnonzero(out & CLOSES)
        sums = np.concatenate(([np.uint64(0)], sums)) + carried
        carried = sums[-1]
        starts.append(opened + at)
        ends.append(closed + at)
        before.append(sums[opened])
        after.append(sums[closed])
        undo.append(INVERSES[opened] * np.uint64(pow(INVERSE, at, 1 << 64)))
        lo, hi = np.searchsorted(last, (at, at + len(block)))
        for total, bit in ((points, POINT), (upper, UPPER), (marks, MARK)):
            so_far = np.cumsum((out & bit) > 0)
            parts = np.diff(np.concatenate(([0], so_far[last[lo:hi] - at], so_far[-1:])))
            total[lo: hi + 1] += parts[: len(total) - lo]
    points -= 1  # the gap byte at each text's end
    start, end = np.concatenate(starts), np.concatenate(ends)
    return points, upper, marks, start, end, (np.concatenate(after) - np.concatenate(before)) * np.concatenate(undo)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the spans of ``n`` bytes from ``a`` and from ``b`` are equal, compared byte for byte."""
    same = np.ones(len(a), bool)
    step = max(1, BLOCK // 4)
    tail = np.cumsum(n)
    cuts = np.unique(np.searchsorted(tail, np.arange(step, int(tail[-1]) if len(n) else 0, step))).tolist() if len(n) else []
    for lo, hi in zip([0, *cuts], [*cuts, len(n)]):
        for first in range(0, int(n[lo:hi].max(initial=0)), step) or [0]:
            length = np.clip(n[lo:hi] - first, 0, step)
            total = int(length.sum())
            if not total:
                continue
            inside = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
            differ = data[np.repeat(a[lo:hi] + first, length) + inside] != data[np.repeat(b[lo:hi] + first, length) + inside]
            same[lo + np.repeat(np.arange(hi - lo), length)[differ]] = False
    return same


def distinct_words(data: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """Number of different words per text: spans inserted into one open-addressing table, equal hashes verified."""
    bits = max(4, int(2 * len(start) + 1).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    mix = (hashes ^ (owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9FB21C651E98DF25)
    slot = (mix >> np.uint64(64 - bits)).astype(np.int64)
    length = end - start
    found = np.zeros(texts, np.int64)
    open_ = np.arange(len(start))
    while len(open_):
        at = slot[open_]
        empty = open_[table[at] < 0]
        table[slot[empty]] = empty  # of the words that reach an empty place in one step, one stays
        holder = table[at]
        mine = holder == open_
        found += np.bincount(owner[open_[mine]], minlength=texts)
        alike = ~mine & (owner[holder] == owner[open_]) & (hashes[holder] == hashes[open_]) & (length[holder] == length[open_])
        seen = np.flatnonzero(alike)
        alike[seen] = _same_bytes(data, start[open_[seen]], start[holder[seen]], length[open_[seen]])
        open_ = open_[~(mine | alike)]
        slot[open_] = (slot[open_] + 1) & ((1 << bits) - 1)
    return found


def count_texts(texts: pa.Array) -> np.ndarray:
    """Per text (null: empty): words, different words, code points, capitals and symbols, as the columns of a matrix."""
    column = texts.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and len(column) else np.zeros(0, np.uint8)
    sizes = np.where(np.asarray(column.is_null()), 0, np.diff(offsets))
    out, lo = np.zeros((len(column), 5), np.int64), 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1)
        data = np.full(int(sizes[lo:hi].sum()) + hi - lo, 0x20, np.uint8)
        last = np.cumsum(sizes[lo:hi] + 1) - 1
        for i, e in zip(range(lo, hi), last.tolist()):
            data[e - sizes[i]: e] = raw[offsets[i]: offsets[i] + sizes[i]]
        points, upper, marks, start, end, hashes = _words(data, last)
        owner = np.searchsorted(last, start)
        out[lo:hi] = np.stack((
            np.bincount(owner, minlength=hi - lo), distinct_words(data, owner, start, end, hashes, hi - lo), points, upper, marks), 1)
        lo = hi
    return out


def text_counts(docs: DataFrame, text_col: str = "text", **keep: Column) -> DataFrame:
    """``keep`` and ``n_words, n_distinct, n_points, n_capitals, n_symbols`` (long) of every row of ``docs``."""

    @F.arrow_udf("struct<n_words:long,n_distinct:long,n_points:long,n_capitals:long,n_symbols:long>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = count_texts(texts)
            names = ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")
            yield pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(5)], names=names)

    return docs.select(*[c.alias(n) for n, c in keep.items()], counts(F.col(text_col)).alias("_n")).select(*keep, "_n.*")


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id, part, content, failed`` per row: the set of filters A-D that its text fails, as bits, and its SHA-256.

    A: under 200 words; B: fewer different words than half of them; C: over 2 capitals (A-Z) in 100 code points;
    D: any of ``#$%&*|``. An empty or null text fails A alone.
    """
    rows = text_counts(
        docs, text_col, doc_id=F.col(id_col), part=F.coalesce(F.col(part_col).cast("string"), F.lit("")),
        content=F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)))
    fails = (F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"),
             100 * F.col("n_capitals") > 2 * F.col("n_points"), F.col("n_symbols") > 0)
    bits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", "content", bits.alias("failed"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    The fifth filter, E, fails a text that a smaller id holds too, in any part and whether removed or not. Null parts are the empty
    string. Rows that repeat an id and a text both count, and neither fails E for the other; a null id never fails
    it and fails no one. Several label rows of an id count as one that has each mark any of them has. An empty table has no parts and gives no rows.
    """
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = failed_filters(docs, id_col, text_col, part_col)
    marked = rows.join(marks, rows["doc_id"] == marks["_id"], "left").select(
        "doc_id", "part", "content", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    kind = ["content", "part", "failed", "good", "toxic"]
    # A text that a third of all rows hold is one row a task and kind before it is shuffled; its smallest id
    # travels with the number of rows that have it.
    same = marked.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy(*kind).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"))
    # Per text at most four rows a part are left here.
    same = same.withColumn("least", F.min("first.doc_id").over(Window.partitionBy("content")))
    alone = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    either = F.array(F.struct(alone.alias("n"), F.col("failed").alias("failed")),
                     F.struct((F.col("n") - alone).alias("n"), (F.col("failed") + 16).alias("failed")))
    sets = same.select("part", "good", "toxic", F.explode(either).alias("e")).groupBy("part", F.col("e.failed").alias("failed")).agg(
        F.sum("e.n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("e.n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("e.n"))), F.lit(0)).alias("toxic"))

    # 80 pairs of a filter and those before it stand for the 600 steps of all orders; at most 32 sets a part.
    pairs = F.array(*[F.struct(F.lit(1 << i).alias("own"), F.lit(before).alias("before"))
                      for i in range(5) for before in range(32) if not before >> i & 1])
    has, earlier = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(value: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(value))), F.lit(0)).cast("long")

    # A set of k failed filters is removed by each of them in 120 / k of the orders.
    share = F.when(has, F.col("n") * F.element_at(F.array(*[F.lit(120 // k) for k in range(1, 6)]), F.greatest(F.lit(1), F.bit_count("failed"))))
    steps = sets.withColumn("p", F.explode(pairs)).select("*", "p.own", "p.before").groupBy("part", "own", "before").agg(
        total("n", ~has & ~earlier).alias("kept"), total("n", has & ~earlier).alias("removed"), total("n", has & earlier).alias("redundant"),
        total("n", F.col("failed") == F.col("own")).alias("unique_fails"), total("good", has & ~earlier).alias("good_lost"),
        total("toxic", has & ~earlier).alias("toxic_lost"), F.coalesce(F.sum(share), F.lit(0)).cast("long").alias("shapley"))
    orders = F.array(*[
        F.struct(F.lit("".join(o)).alias("filter_order"), F.lit(step + 1).alias("step"), F.lit(1 << FILTERS.index(o[step])).alias("_own"),
                 F.lit(sum(1 << FILTERS.index(f) for f in o[:step])).alias("_before"))
        for o in permutations(FILTERS) for step in range(5)])
    orders = docs.sparkSession.range(1).select(F.explode(orders).alias("o")).select("o.*")  # 600 rows at any size
    return steps.join(F.broadcast(orders), (F.col("own") == F.col("_own")) & (F.col("before") == F.col("_before"))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
