"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken ``rate = target / source size`` times on average: its whole part
for certain, its fraction as the inclusion probability of one more copy. The probabilities are
moved through the null space of two constraints, the source's words and its documents, until each
is 0 or 1: three open documents at a time, whose move keeps both totals exactly. This flight runs
in blocks of bounded size; a block leaves ten open documents at most, which meet those of
other blocks in the next round, until one small group is left per source. There the landing tries all
outcomes of the last ten documents and takes the one nearest to the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import whole_rows, written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 4096
FAN_IN = 256
LANDING = 10
COPIES = "row long, doc_id long, source_no int, size long, source_size long, target double, whole long, pi double, block long"


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_no, source_size, documents, target`` for rows of ``source, size``; one row per source.

    Sources in code point order, null last, get the weights in turn and share ``share`` times all words; a
    target stops at ``most`` times its source's size and the excess goes to the others by weight. The
    two windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("source_no", F.lit(len(weights))) + 1)
    rows = per_source.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    rows = rows.withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    total = share * F.sum("source_size").over(everything)
    earlier = lambda c: F.coalesce(F.sum(c).over(by_ratio), F.lit(0.0))
    # Filled from the smallest cap per weight up: a source is capped if the level that is left reaches its cap.
    level = (total - earlier("cap")) / (F.sum("weight").over(everything) - earlier("weight"))
    rows = rows.withColumn("total", total).withColumn("level", level)
    rows = rows.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    spare = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(
        F.col("cap"), (F.col("total") - spare) * F.col("weight") / open_weight))
    return rows.select("source", F.col("source_no").cast("int").alias("source_no"), "source_size", "documents", target.alias("target"))


def flight(size: np.ndarray, pi: np.ndarray, random: np.random.Generator, leave: int = LANDING) -> np.ndarray:
    """Moves probabilities until at most ``leave`` (2 at least) are open; sums of pi and of size * pi stay."""
    pi = pi.copy()
    low = 1e-9
    waiting = [i for i in range(len(pi) - 1, -1, -1) if low < pi[i] < 1 - low]
    hand: list[int] = []
    n_open = len(waiting)
    p, s = pi.tolist(), size.tolist()
    draws = iter(random.random(2 * len(p) + 8).tolist())
    while n_open > leave:
        while len(hand) < 3 and waiting:
            hand.append(waiting.pop())
        if len(hand) == 3:
            a, b, c = hand
            u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
            if not any(u):
                u = (1, -1, 0)
        elif len(hand) == 2 and s[hand[0]] == s[hand[1]]:
            u = (1, -1)
        else:
            break
        up = down = float("inf")
        for i, d in zip(hand, u):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, p[i] / -d), min(down, (1 - p[i]) / -d)
        step = up if next(draws) * (up + down) < down else -down
        still = []
        for i, d in zip(hand, u):
            x = p[i] + step * d
            p[i] = 0.0 if x < low else 1.0 if x > 1 - low else x
            if 0 < p[i] < 1:
                still.append(i)
        n_open -= len(hand) - len(still)
        hand = still
    out = np.array(p)
    out[out < low], out[out > 1 - low] = 0.0, 1.0
    return out


def landing(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """The 0/1 outcome of the few open documents that is nearest to the word total, then the document total."""
    at = np.flatnonzero((pi > 0) & (pi < 1))
    if not len(at):
        return pi
    ways = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
    words = np.abs((ways - pi[at]) @ size[at].astype(float))
    count = np.abs((ways - pi[at]).sum(1))
    out = pi.copy()
    out[at] = ways[np.lexsort((np.arange(len(ways)), count, words.round(6)))[0]]
    return out


def _fly(land: bool, round_no: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "row", "doc_id"], ascending=[False, True, True], ignore_index=True) if land else \
            rows.sort_values(["row", "doc_id", "size"], ignore_index=True)
        size, pi = rows["size"].to_numpy(), rows["pi"].to_numpy()
        random = np.random.default_rng([round_no, int(key[0]), int(key[1])])
        pi = flight(size, pi, random, LANDING)
        return rows.assign(pi=landing(size, pi) if land else pi)

    return run


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often the mix takes each document: ``doc_id, size, source_size, target, taken, copies, row``.

    ``size`` counts words (null text: 0); ``copies`` is how many times the document is taken, ``taken`` its words times
    that. A null source is a source. Repeated rows are drawn one by one; ``row`` is a hash of id, source and text by
    which, with the id, callers can find the rows again. Draws depend on the rows alone, so a rerun
    agrees. Empty table: no rows.

    Rows that agree in id, source and text are counted first and numbered afterwards in portions of ``BLOCK``, dealt
    out one by one: a row that a third of the table repeats fills as many blocks as it needs and no task of its own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.xxhash64(F.col(id_col), F.col(source_col), text).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    sized = written(sized, "sizes")
    targets = source_targets(sized, weights, share, most)
    t = written(targets, "targets").withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same = sized.groupBy("row", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times"))
    portions = same.withColumn("portion", F.explode(F.sequence(F.lit(0), ((F.col("times") - 1) / BLOCK).cast("int"))))
    rows = portions.repartition("row", "doc_id", "portion").join(t, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "nth", F.explode(F.sequence(F.lit(1), F.least(F.lit(BLOCK), F.col("times") - BLOCK * F.col("portion")).cast("int")))).select(
        "row", "doc_id", "source_no", "size", "source_size", "target", F.floor(rate).alias("whole"),
        (rate - F.floor(rate)).alias("pi"),
        F.pmod(F.xxhash64("row", "portion", "nth"), F.ceil(F.col("documents") / BLOCK)).cast("long").alias("block"))
    blocks = t.agg(F.max(F.ceil(F.col("documents") / BLOCK))).first()[0] or 1
    left = written(rows.groupBy("source_no", "block").applyInPandas(_fly(False, 0), COPIES), "flight")
    is_open = (F.col("pi") > 0) & (F.col("pi") < 1)
    done, round_no = [left.filter(~is_open)], 0
    while True:
        round_no, blocks = round_no + 1, -(-blocks // FAN_IN)
        moved = left.filter(is_open).withColumn("block", F.pmod("block", F.lit(blocks)))
        left = written(moved.groupBy("source_no", "block").applyInPandas(_fly(blocks == 1, round_no), COPIES), "flight")
        done.append(left.filter(~is_open))
        if blocks == 1:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = F.col("whole") + F.col("pi").cast("long")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), "row")


def take(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, its columns unchanged. Takes ``mix``'s options."""
    names = {k: options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    key = F.xxhash64(F.col(names["id_col"]), F.col(names["source_col"]), F.coalesce(F.col(names["text_col"]), F.lit("")))
    copies = mix(docs, **options).groupBy("row", "doc_id").agg(F.sum("copies").cast("int").alias("copies")).filter("copies > 0")
    copies = copies.select(F.col("row").alias("key_of"), F.col("doc_id").alias("id_of"), "copies")
    # Repeated rows share hash and id: one of them carries the copies of all.
    rows = whole_rows(docs, key=key, id=F.col(names["id_col"]).cast("long")).dropDuplicates(["key", "id"])
    found = rows.join(copies, (F.col("key") == F.col("key_of")) & F.col("id").eqNullSafe(F.col("id_of")))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
