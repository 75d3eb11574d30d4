"""Near-duplicates: SuperMinHash signatures, banding, verification on full sets, and grouping.

SuperMinHash gives every shingle one random permutation of the slots instead of one hash a slot; the ranks
within it are correlated, so estimates vary less, and a document is done as soon as no later rank
could lower a slot. Documents with equal sets become one class. Each bucket links its classes to one
leader only; most of a group is joined by these few links. Rounds of new leaders follow, each with a few comparisons
a class, as long as they join components. Classes of a bucket that are still apart afterwards are then compared with each
other, but for pairs whose rare shingles rule a link out; so no link that would join different components of a bucket is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches, text_rows, whole_rows, written
from noticemill.llm.components import components

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
RANK = np.uint64(40)  # a slot's value: the rank above, 32 random bits below


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it has grown past a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, width: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle, one without words none."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mixed(out * GOLDEN + h[i: len(h) - n + 1 + i])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures of the sets, one row each; rows of empty sets are all ones."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    best = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat = best.reshape(-1)
    moved_to: list[np.ndarray] = []
    moved: list[np.ndarray] = []

    def at(place: np.ndarray) -> np.ndarray:
        """What stands at a place of each item's permutation after the swaps so far."""
        out = place.copy()
        for k, v in zip(moved_to, moved):
            np.copyto(out, v, where=k == place)
        return out

    for j in range(slots):
        draw = mixed(items + np.uint64(j + 1) * GOLDEN)
        k = (j + (((draw >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int16)).astype(np.int16)
        slot, here = at(k), at(np.full(len(items), j, np.int16))
        moved_to.append(k)
        moved.append(here)
        np.minimum.at(flat, owner * slots + slot, (np.uint64(j) << RANK) | (draw & np.uint64(0xFFFFFFFF)))
        unfinished = best.max(1) >= (np.uint64(j + 1) << RANK)
        going = unfinished[owner]
        if not going.any():
            break
        if not going.all():
            owner, items = owner[going], items[going]
            moved_to, moved = [x[going] for x in moved_to], [x[going] for x in moved]
    return best


def sketch(docs: DataFrame, width: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, set_key`` (a 128-bit hash of the set) and ``bands`` (a hash each) per document."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        words = WordHashes()
        weights = mixed(np.arange(1, rows + 1).astype(np.uint64) * GOLDEN) | np.uint64(1)
        for batch in batches:
            sets = [shingles(t, width, words) for t in batch["text"]]
            with np.errstate(over="ignore"):
                signature = super_minhash(sets, bands * rows).reshape(len(sets), bands, rows)
                keys = mixed((mixed(signature) * weights).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * GOLDEN)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "n_shingles": [len(s) for s in sets],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "bands": list(keys.view(np.int64)),
            })

    return text_rows(docs, id_col, text_col).mapInPandas(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b`` of pairs whose full sets have ``100 * intersection >= percent * union``, enough of them to join what they join.

    ``pairs`` may name components ``ca, cb`` that earlier links have made. A task joins the components of the links it finds and
    passes over pairs whose ends it has joined already, so it returns a forest: fewer links than it met components, however
    many pairs of a group are linked. What is joined is the same for any order of rows.
    """
    placed = "ca" in pairs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        last: tuple[str, np.ndarray] | None = None
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.get(x, x)) != x:
                above[x] = above.get(up, up)
                x = up
            return x

        for batch in batches:
            linked = []
            for ta, tb, ca, cb in zip(batch["text_a"], batch["text_b"], batch["ca"].tolist(), batch["cb"].tolist()):
                ca, cb = root(ca), root(cb)
                if ca == cb:
                    linked.append(False)
                    continue
                if last is None or last[0] != tb:
                    last = (tb, shingles(tb, width, words))
                sa, sb = shingles(ta, width, words), last[1]
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                linked.append(100 * both >= percent * (len(sa) + len(sb) - both) > 0)
                if linked[-1]:
                    above[ca] = cb
            yield batch.loc[np.array(linked, bool), ["a", "b"]]

    parts = ["a", "b", *(("ca", "cb") if placed else (F.col("a").alias("ca"), F.col("b").alias("cb")))]
    with_a = pairs.select(*parts).join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return with_b.select("a", "b", "ca", "cb", "text_a", "text_b").mapInPandas(run, "a long, b long").distinct()


def rare_shingles(texts: DataFrame, width: int) -> DataFrame:
    """``doc_ids``: for every shingle that at most three rows of ``texts`` hold, the documents that do."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            sets = [shingles(t, width, words) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": np.repeat(batch["doc_id"].to_numpy(), [len(s) for s in sets]),
                                "shingle": np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)})

    rows = texts.select("doc_id", "text").mapInPandas(run, "doc_id long, shingle long")
    held = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.bit_xor("doc_id").alias("xor"))
    # Of three ids, the one in the middle is what is left of their exclusive or.
    middle = F.when(F.col("n") == 3, F.col("low").bitwiseXOR(F.col("high")).bitwiseXOR(F.col("xor"))).otherwise(F.col("low"))
    return held.filter("n <= 3").select(F.array_sort(F.array_distinct(F.array("low", middle, "high"))).alias("doc_ids"))


def leader_pairs(placed: DataFrame, percent: int, number: int, asks: int = 8) -> DataFrame:
    """``a, b, ca, cb``: for each class whose buckets hold other components, up to ``asks`` members of them to compare it with.

    Every bucket elects as many members by hashes that change from round to round, mostly of its largest component. In each of its
    buckets a class votes for one of them, drawn by a hash of both where the sizes of their sets allow a link, and
    asks those with most of its votes: a bucket costs one row a member, however many lead it.
    """
    draws = [F.min(F.struct(F.xxhash64("rep", F.lit(number * asks + k)).alias("draw"), "rep", "component", "n_shingles")) for k in range(asks)]
    leaders = placed.groupBy("bucket").agg(
        F.array(*draws).alias("leaders"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select(
        "bucket", "leaders")
    fit = F.filter("leaders", lambda x: (x["component"] != F.col("component")) & (
        100 * F.least(F.col("n_shingles"), x["n_shingles"]) >= percent * F.greatest(F.col("n_shingles"), x["n_shingles"])))
    vote = F.array_min(F.transform(fit, lambda x: F.struct(
        F.xxhash64(x["rep"], F.col("rep"), F.lit(number)).alias("draw"), x["rep"].alias("rep"), x["component"].alias("component"))))
    cast = placed.join(leaders, "bucket").select("rep", "component", vote.alias("leader")).filter("leader IS NOT NULL")
    votes = cast.groupBy("rep", F.col("leader.rep").alias("to")).agg(
        F.count(F.lit(1)).alias("n"), F.first("component").alias("cr"), F.first("leader.component").alias("ct"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("n"), "to"))  # at most as many rows a class as it has buckets
    best = votes.withColumn("place", place).filter(F.col("place") <= asks)
    return best.select(F.greatest("rep", "to").alias("a"), F.least("rep", "to").alias("b"), F.greatest("cr", "ct").alias("ca"),
                       F.least("cr", "ct").alias("cb")).dropDuplicates(["a", "b"])


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 28, rows: int = 6,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; documents are linked when the sets
    of their ``width``-word shingles meet ``percent``; ``component_id`` is the smallest id reachable. Null and empty
    texts, and those without words, are linked with nothing. With 28 bands of 6 rows a pair at 0.85 misses all
    buckets with a chance of 2 in a million, one at 0.8 of 2 in ten thousand.
    Rows that repeat an id are one document, linked by any of its texts; a null id has a null component and stays.
    """
    nodes = written(sketch(docs, width, bands, rows, id_col, text_col), "sketches")
    classes = nodes.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    reps = nodes.join(classes, (nodes["set_key"] == classes["set_key"]) & (nodes["doc_id"] == classes["rep"]), "left_semi")
    postings = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "hash")).select(
        F.xxhash64("band", "hash").alias("bucket"), F.col("doc_id").alias("rep"), "n_shingles")
    leaders = postings.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).filter("leader <> last")
    shared = written(postings.join(leaders.drop("last"), "bucket"), "buckets")

    # One leader per class: that of most of its buckets.
    votes = shared.filter("rep <> leader").groupBy("rep", "leader").count()
    star = votes.groupBy("rep").agg(F.max_by("leader", F.struct("count", -F.col("leader"))).alias("leader"))
    star = written(star.select(F.col("rep").alias("a"), F.col("leader").alias("b")), "star")
    involved = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = written(text_rows(docs, id_col, text_col).join(involved, "doc_id", "left_semi"), "texts")
    links = written(verified(star, texts, width, percent), "verified")
    tried, number = star, 0
    while True:
        first = components(links)
        placed = written(shared.join(first, shared["rep"] == first["node"], "left").select(
            "bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("component")), "placed")
        number += 1
        asked = written(leader_pairs(placed, percent, number).join(tried, ["a", "b"], "left_anti"), "asked")
        met = written(verified(asked, texts, width, percent), "met")
        n_asked, n_met = asked.count(), met.count()
        links, tried = links.union(met), tried.union(asked.select("a", "b"))
        # While some of the questions join components, a round of a few questions a class saves many pairs of the last step.
        if 50 * n_met < n_asked or not n_met:
            break

    # What is still apart within a bucket is compared across components.
    if n_met:
        first = components(links)
        placed = shared.join(first, shared["rep"] == first["node"], "left").select(
            "bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    split = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    open_rows = written(placed.join(split.select("bucket"), "bucket", "left_semi"), "open")
    rare = written(rare_shingles(texts.join(open_rows.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), width), "rare")
    own = rare.select(F.explode("doc_ids").alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rare"))
    # Pairs that share a rare shingle are found by it. All others share at most what neither has of rare ones, which
    # rules out most pairs of a bucket; the rest are found in the first bucket they share.
    buckets = open_rows.groupBy("rep").agg(F.collect_list("bucket").alias("buckets"))
    bounded = open_rows.join(own, open_rows["rep"] == own["doc_id"], "left").select(
        "bucket", "rep", "component", "n_shingles", (F.col("n_shingles") - F.coalesce("rare", F.lit(0))).alias("shareable"))
    bounded = written(bounded.filter(100 * F.col("shareable") >= percent * F.col("n_shingles")).join(buckets, "rep"), "bounded")
    x, y = bounded.alias("x"), bounded.alias("y")
    overlap = F.least("x.shareable", "y.shareable")
    by_bucket = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.rep") > F.col("y.rep"))
                       & (F.col("x.component") != F.col("y.component"))
                       & (100 * overlap >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles") - overlap))
                       & (F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket"))).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.component").alias("ca"), F.col("y.component").alias("cb"))
    at = lambda i: F.get("doc_ids", F.lit(i))
    both = F.array(*[F.struct(at(i).alias("a"), at(j).alias("b")) for i, j in ((1, 0), (2, 0), (2, 1))])
    two = rare.filter(F.size("doc_ids") > 1).select(F.explode(F.filter(both, lambda p: p["a"].isNotNull())).alias("p")).select(
        "p.a", "p.b").distinct()
    about = open_rows.groupBy("rep").agg(F.first("component").alias("component"), F.first("n_shingles").alias("n"))
    by_rare = (
        two.join(about.select(F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na")), "a")
        .join(about.select(F.col("rep").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb")), "b")
        .filter((F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b", "ca", "cb"))
    pairs = written(by_bucket.union(by_rare).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    more = verified(pairs, texts, width, percent)
    grouped = components(links.union(more))

    by_class = classes.join(grouped, classes["rep"] == grouped["node"], "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    return nodes.join(by_class, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest id of its group; takes ``near_groups``' options."""
    stay = near_groups(docs, id_col=id_col, **options).filter("kept").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")).distinct()
    rows = whole_rows(docs, key=F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return rows.join(stay, "key", "left_semi").select("row.*")
