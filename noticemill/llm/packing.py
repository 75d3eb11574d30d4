"""Best-fit packing of documents into token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so all planning is done on their histogram, which
has at most ``capacity`` rows at any size of the corpus. Large lengths are rounded up within groups
of equal cardinality; few sizes remain, whose configurations a linear program chooses (columns
by a knapsack recursion). Real lengths then take the slots, and small ones and what rounding left
over are placed by best fit into the room that is really left. The plan says where the i-th
piece of each length goes; Spark numbers the pieces and joins them with it.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches, shuffle_partitions, text_rows, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, first long, n long, sequence_id long, offset long"
# A plan of at most this many rows (40 bytes each) is broadcast; a longer one is joined by shuffling.
BROADCAST_PLAN_ROWS = 200_000


# --- tokens -------------------------------------------------------------------------------------

class Encoder:
    """Ids exactly as ``tokenizers`` gives them for ``<name>.json``, found by a faster way where that is certain."""

    def __init__(self, name: str) -> None:
        import base64

        import public_tokenizers as vocabularies
        import tiktoken
        from tokenizers import Tokenizer

        with open(vocabularies.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pattern = vocabularies.PATTERN
        # The look-ahead matters only where two white-space characters meet.
        simple = pattern.replace(r"|\s+(?!\S)", "")
        self.exact = tiktoken.Encoding("exact", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.fast = tiktoken.Encoding("fast", pat_str=simple, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(vocabularies.path(f"{name}.json"))
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.spaces = re.compile(r"\s\s")

    def __call__(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.full.encode(text, add_special_tokens=False).ids
        return (self.exact if self.spaces.search(text) else self.fast).encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def token_pieces(docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k", end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every document as ids and ``end_id``, cut into pieces of ``capacity``; the first may be shorter.

    ``doc_id, piece, start, length, ids_crc32`` and with ``keep_ids`` also ``ids``. A null or empty text has the end
    id alone; a null id stays null; repeated rows have pieces of their own; an empty table has none.
    """
    bounded_batches(docs.sparkSession, 500)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array(encode(text) + [end_id], "<u4")
                first = (len(ids) - 1) % capacity + 1
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    row = (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    out.append((*row, ids[a:b].astype("int64")) if keep_ids else row)
            names = [c.split()[0] for c in schema.split(", ")]
            frame = pd.DataFrame(out, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = PIECES + (", ids array<long>" if keep_ids else "")
    return text_rows(docs, id_col, text_col).mapInPandas(cut, schema)


# --- the plan -------------------------------------------------------------------------------------

def best_patterns(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of sizes within the capacity whose values add up to most, as counts."""
    most = capacity // int(sizes.min())
    best, choice = np.zeros(capacity + 1), []
    for _ in range(most):
        grown = np.full((len(sizes), capacity + 1), -1.0)
        for i, s in enumerate(sizes):
            grown[i, s:] = best[: capacity + 1 - s] + values[i]
        pick = grown.argmax(0)
        top = grown[pick, np.arange(capacity + 1)]
        pick[top <= best] = -1
        best = np.maximum(best, top)
        choice.append(pick)
    counts, room = np.zeros(len(sizes)), capacity
    for pick in reversed(choice):
        if pick[room] >= 0:
            counts[pick[room]] += 1
            room -= sizes[pick[room]]
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use each: the linear program by column generation, rounded down."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    for _ in range(rounds):
        duals = inverse.sum(0)
        column = best_patterns(sizes, duals, capacity)
        if column @ duals <= 1 + 1e-7:
            break
        x, step = inverse @ demand, inverse @ column
        ratios = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        leaving = int(ratios.argmin())
        if not np.isfinite(ratios[leaving]):
            break
        basis[:, leaving] = column
        inverse[leaving] /= step[leaving]
        others = np.arange(m) != leaving
        inverse[others] -= np.outer(step[others], inverse[leaving])
    x = np.linalg.solve(basis, demand.astype(float))
    return [(basis[:, j].astype(int), int(np.floor(x[j] + 1e-9))) for j in range(m) if x[j] >= 1 - 1e-9]


def plan_packing(histogram: dict[int, int], capacity: int, groups: int = 96, large: float = 0.2) -> list[tuple[int, ...]]:
    """Placements ``(length, first, n, sequence_id, offset)`` of runs of pieces.

    The pieces ``first`` to ``first + n - 1`` of a length go to the sequences from ``sequence_id`` on, one each.
    """
    left = {s: n for s, n in histogram.items() if n}
    taken = dict.fromkeys(left, 0)
    plan: list[tuple[int, ...]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> runs of sequences (first, n) that have it
    keys: list[int] = []
    next_sequence = 0

    def put_back(room: int, first: int, n: int) -> None:
        if not room:
            return
        if room not in rooms:
            rooms[room] = []
            bisect.insort(keys, room)
        rooms[room].append((first, n))

    def place(size: int, n: int, sequence: int, offset: int) -> None:
        plan.append((size, taken[size], n, sequence, offset))
        taken[size] += n
        left[size] -= n

    if left.get(capacity):
        n = left[capacity]
        place(capacity, n, 0, 0)
        next_sequence = n

    # Linear grouping: members of a group are rounded up to the largest.
    big = sorted((s for s, n in left.items() if n and s > large * capacity), reverse=True)
    total = sum(left[s] for s in big)
    members: list[list[int]] = []
    held = 0
    for s in big:
        if not members or held >= total / groups:
            members.append([])
            held = 0
        members[-1].append(s)
        held += left[s]
    if members:
        sizes = np.array([g[0] for g in members])
        demand = np.array([sum(left[s] for s in g) for g in members])
        for pattern, times in configurations(sizes, demand, capacity):
            slots = [g for g, k in enumerate(pattern) for _ in range(k)]
            # Runs of the new sequences that hold the same real lengths so far.
            runs = [(next_sequence, times, 0)]
            next_sequence += times
            for g in slots:
                filled = []
                for first, n, used in runs:
                    while n:
                        size = next((s for s in members[g] if left[s]), 0)
                        if not size:
                            filled.append((first, n, used))
                            break
                        k = min(n, left[size])
                        place(size, k, first, used)
                        filled.append((first, k, used + size))
                        first, n = first + k, n - k
                runs = filled
            for first, n, used in runs:
                put_back(capacity - used, first, n)

    for size in sorted((s for s, n in left.items() if n), reverse=True):
        while left[size]:
            at = bisect.bisect_left(keys, size)
            if at == len(keys):
                n = -(-left[size] // (capacity // size))
                put_back(capacity, next_sequence, n)
                next_sequence += n
                continue
            room = keys[at]
            first, n = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], keys[at]
            k = min(n, left[size])
            place(size, k, first, capacity - room)
            if n > k:
                put_back(room, first + k, n - k)
            put_back(room - size, first, k)
    return plan


# (groups, share of the capacity above which a length counts as large)
SETTINGS = ((96, 0.12), (96, 0.2), (96, 0.3), (48, 0.5))


def best_plan(histogram: dict[int, int], capacity: int, settings: tuple = SETTINGS) -> list[tuple[int, ...]]:
    """The plan with the fewest sequences among several group counts and bounds of what is large."""
    plans = [plan_packing(histogram, capacity, groups, large) for groups, large in settings]
    return min(plans, key=lambda p: max((seq + n for _, _, n, seq, _ in p), default=0))


# --- pieces meet the plan -------------------------------------------------------------------------

def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, packed into few sequences of at most ``capacity``.

    ``pieces`` has ``doc_id, piece, length, ids_crc32`` and any other columns but those two; it is read twice, so pass
    a table. Each length's pieces are numbered within hashed buckets whose counts give their first number:
    a length that many pieces share is spread over all buckets.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_plan(histogram, capacity)
    buckets = max(32, shuffle_partitions(spark))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("held")).select(
        "length", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        rows.withColumn("nth", F.row_number().over(within))
        .join(firsts, ["length", "bucket"])
        .withColumn("nth", F.col("before") + F.col("nth") - 1).drop("before", "bucket")
    )
    places = spark.createDataFrame(plan, PLAN)
    if len(plan) <= BROADCAST_PLAN_ROWS:
        places = F.broadcast(places)
    p = places.withColumnRenamed("length", "plan_length")
    inside = (F.col("length") == F.col("plan_length")) & (F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("first") + F.col("n"))
    return numbered.join(p, inside).select(
        *pieces.columns, (F.col("sequence_id") + F.col("nth") - F.col("first")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k", end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """All documents cut into pieces and packed; columns of ``token_pieces`` with ``sequence_id`` and ``offset``."""
    pieces = token_pieces(docs, capacity, vocabulary, end_id, id_col, text_col, keep_ids)
    return pack(written(pieces, "pieces"), capacity)
