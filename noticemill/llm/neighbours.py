"""Approximate nearest neighbours by cosine: a forest of random-projection trees with one priority queue.

The trees are fitted on a bounded sample; every row is then led to one leaf per tree. A query enters all trees at
once: each way it does not take is queued with the margin it misses by, the queue is shared, and
the leaves with the best margins over all trees are visited. A leaf's priority is the least margin on its
path, which never rises downwards, so the order in which the queue gives out leaves is the order
of these priorities. Candidates of the visited leaves are ranked by their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches, written

BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048
# Candidates whose cosines differ by less may change places when they are computed exactly.
ROUNDING = 1e-12


class Forest:
    """Perfect binary trees: node ``i`` has children ``2i + 1`` (projection at or below its bound) and ``2i + 2``."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int) -> None:
        random = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        nodes, width = (1 << depth) - 1, sample.shape[1] if sample.size else 1
        self.planes = np.zeros((trees, nodes, width))
        self.bounds = np.zeros((trees, nodes))
        for t in range(trees):
            members = {0: np.arange(len(sample))}
            for i in range(nodes):
                mine = members.pop(i)
                if len(mine) > 1:
                    a, b = sample[random.choice(mine, 2, replace=False)]
                    plane = a - b
                if len(mine) < 2 or not plane.any():
                    plane = random.normal(size=width)
                plane = plane / np.linalg.norm(plane)
                at = sample[mine] @ plane if len(mine) else np.zeros(0)
                bound = float(np.median(at)) if len(mine) else 0.0
                self.planes[t, i], self.bounds[t, i] = plane, bound
                members[2 * i + 1], members[2 * i + 2] = mine[at <= bound], mine[at > bound]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree: rows by trees, numbered through all trees."""
        out = np.empty((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.planes[t][node]) > self.bounds[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - ((1 << self.depth) - 1) + (t << self.depth)
        return out

    def best_leaves(self, x: np.ndarray, visit: int) -> np.ndarray:
        """The ``visit`` leaves that the shared queue gives out first, for each row."""
        priorities = []
        for t in range(self.trees):
            margin = x @ self.planes[t].T - self.bounds[t]
            now = np.full((len(x), 1), np.inf)
            for level in range(self.depth):
                m = margin[:, (1 << level) - 1: (1 << (level + 1)) - 1]
                down = np.empty((len(x), 2 << level))
                down[:, 0::2], down[:, 1::2] = np.minimum(now, -m), np.minimum(now, m)
                now = down
            priorities.append(now)
        every = np.concatenate(priorities, 1)
        visit = min(visit, every.shape[1])
        return np.argpartition(-every, visit - 1, 1)[:, :visit]


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, original`` (doubles) of the vectors that take part; ``v`` is divided by the largest component.

    Vectors that are exact multiples of one another have equal ``v``, bit by bit.

    Left out: null ids, vectors that are null, empty, zero, hold null or non-finite components, or are of another
    length than most (of equal counts the longer). Rows that repeat an id and a direction count once,
    as the least of their vectors.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    found = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    top = found.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    largest = F.array_max(F.transform("v", lambda x: F.abs(x))).alias("largest")
    found = found.filter(F.size("v") == (top["n"] if top else 0)).select("vec_id", "v", largest)
    found = found.select("vec_id", F.transform("v", lambda x: x / F.col("largest")).alias("v"), F.col("v").alias("original"))
    return found.groupBy("vec_id", "v").agg(F.min("original").alias("original"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles; null where their squares leave the range of doubles."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    product = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    found = F.try_divide(dot(a, b), product)
    return F.when((product > 1e-150) & (product < 1e150), found)


def _unit(packed: pd.Series) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(rows: DataFrame, is_query: Column, k: int = 5, trees: int = 12, sample_rows: int = 16_384, leaf_rows: int = 64,
            visit_share: float = 0.06, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row for which ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``. The forest is fitted on at most ``sample_rows`` rows (those
    whose ids hash lowest) down to about ``leaf_rows`` of them a leaf; every row is indexed.
    ``visit_share`` of all leaves, twice as many as trees at least, are visited per query. Of vectors of one direction only the ``k + 1`` with the smallest ids can be
    in an answer, so these stand for all. Nearest first, ties to the smaller id; a query is no neighbour of itself.
    The score is taken from the vectors as given; where their squares leave the range of doubles, from ``v`` of :func:`usable`.
    The order goes by ``v``, as vectors of one direction are ties and their scores may differ in the last bits.
    """
    spark = rows.sparkSession
    bounded_batches(spark, 4000)
    valid = written(usable(rows, id_col, vector_col), "vectors")
    same = Window.partitionBy("v").orderBy("vec_id")
    indexed = written(valid.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1).drop("nth"), "indexed")
    sample = indexed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toPandas()["v"]
    x = np.stack(sample.to_list()) if len(sample) else np.zeros((0, 1))
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x
    depth = max(1, int(np.ceil(np.log2(max(2, len(x)) / leaf_rows)))) if len(x) > leaf_rows else 1
    visit = max(k, 2 * trees, int(np.ceil(visit_share * trees * (1 << depth))))
    forest = spark.sparkContext.broadcast(Forest(x, trees, depth, seed))

    def led(batches: Iterator[pd.DataFrame], visits: int = 0) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            packed = [np.asarray(v, np.float64).tobytes() for v in batch["v"]]
            unit = _unit(packed)
            leaves = forest.value.best_leaves(unit, visits) if visits else forest.value.leaves(unit)
            yield pd.DataFrame({"id": np.repeat(batch["vec_id"].to_numpy(), leaves.shape[1]), "leaf": leaves.ravel(),
                                "v": [p for p in packed for _ in range(leaves.shape[1])]})

    led_schema = "id long, leaf long, v binary"
    data = indexed.select("vec_id", "v").mapInPandas(led, led_schema)
    queries = valid.filter(is_query).select("vec_id", "v").mapInPandas(lambda b: led(b, visit), led_schema)
    data, queries = written(data, "leaves"), written(queries, "visits")
    # Large leaves are cut into blocks on both sides; there are trees * 2 ** depth leaves at any size.
    parts = lambda d, n, name: d.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / n).cast("int").alias(name))
    cuts = written(parts(data, BLOCK_ROWS, "row_blocks").join(parts(queries, BLOCK_QUERIES, "query_blocks"), "leaf"), "cuts")
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    data = data.join(cuts, "leaf").withColumn("rb", F.pmod(F.xxhash64("id"), F.col("row_blocks")).cast("int")).withColumn(
        "qb", spread(F.col("query_blocks"))).select("leaf", "rb", "qb", "id", "v")
    queries = queries.join(cuts, "leaf").withColumn("qb", F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int")).withColumn(
        "rb", spread(F.col("row_blocks"))).select("leaf", "rb", "qb", "id", "v")
    most = 2 * (k + 1)

    def rank(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": [], "near": []})
        ids, near = own["id"].to_numpy(), _unit(asking["v"]) @ _unit(own["v"]).T
        n = min(most, len(ids))
        last = np.partition(near, len(ids) - n, 1)[:, len(ids) - n]
        asked, at = np.nonzero(near >= last[:, None] - ROUNDING)
        return pd.DataFrame({"query_id": asking["id"].to_numpy()[asked], "vec_id": ids[at], "near": near[asked, at]})

    keys = ["leaf", "rb", "qb"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(rank, "query_id long, vec_id long, near double")
    best = found.filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("near").alias("near"))
    by_near = Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    best = best.withColumn("nth", F.row_number().over(by_near))
    last = F.max(F.when(F.col("nth") == most, F.col("near"))).over(Window.partitionBy("query_id"))
    best = best.withColumn("last", last).filter((F.col("nth") <= most) | (F.col("near") >= F.col("last") - ROUNDING))
    asking = valid.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("original").alias("q_original"))
    by_direction = cosine(F.col("q"), F.col("v"))
    exact = best.select("query_id", "vec_id").join(asking, "query_id").join(indexed, "vec_id").select(
        "query_id", "vec_id", by_direction.alias("by_direction"),
        F.coalesce(cosine(F.col("q_original"), F.col("original")), by_direction).alias("score"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("by_direction"), "vec_id")
    return exact.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
