"""Language identification by rank-order n-gram profiles and the out-of-place distance.

A profile is the list of a language's most frequent letter n-grams (one to three letters, word ends
count as a letter) over all its training texts. A document's own list is compared with each: every
n-gram adds how far its rank is out of place, or the list's length if it is missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches

RANKS = 300
EDGE = 1
WIDTH = 21  # bits of a code point


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers; empty if it has no letter. Lone surrogates count as no letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    if not len(codes):
        return codes
    codes[~letters()[codes]] = EDGE
    codes = np.concatenate(([EDGE], codes, [EDGE])).astype(np.uint64)
    codes = codes[np.concatenate(([True], (codes[1:] != EDGE) | (codes[:-1] != EDGE)))]
    if len(codes) < 3:
        return codes[:0]
    one = codes[codes != EDGE]
    pairs = (codes[:-1] << np.uint64(WIDTH)) | codes[1:]
    middle = codes[1:-1] != EDGE
    triples = (pairs[:-1][middle] << np.uint64(WIDTH)) | codes[2:][middle]
    return np.concatenate((one, pairs, triples))


def ranked(keys: np.ndarray, most: int) -> np.ndarray:
    """The most frequent keys first; ties by key."""
    found, counts = np.unique(keys, return_counts=True)
    if len(found) > 4 * most:  # ties at the cut are all kept for the sort
        cut = np.partition(counts, len(counts) - most)[len(counts) - most]
        found, counts = found[counts >= cut], counts[counts >= cut]
    return found[np.lexsort((found, -counts))[:most]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """``lang, gram, place`` (from 0) of every language; rows with null text or language teach nothing."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found, n = np.unique(np.concatenate([grams(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": found.astype("int64"), "n": n})

    texts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = texts.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < ranks).select("lang", "gram", "place")


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: int = RANKS) -> DataFrame:
    """``doc_id, lang_pred, score``: the nearest profile and 1 minus its distance as a share of the largest possible.

    ``und`` and 0 where the text is null or has no letter, or where there is no profile. Equal
    distances go to the first language in order. Profiles hold ``ranks`` rows a language.
    """
    bounded_batches(docs.sparkSession)
    rows = profiles.orderBy("lang", "place").collect()
    langs = sorted({r["lang"] for r in rows})
    known = np.array(sorted({r["gram"] for r in rows}), np.uint64)
    places = np.full((len(langs), len(known) + 1), -1, np.int64)
    for r in rows:
        places[langs.index(r["lang"]), np.searchsorted(known, np.uint64(r["gram"]))] = r["place"]

    def nearest(text: str | None) -> tuple[str, float]:
        own = ranked(grams(text), ranks) if text else known[:0]
        if not len(own) or not langs:
            return "und", 0.0
        at = np.searchsorted(known, own)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
        theirs = places[:, at]
        distance = np.where(theirs < 0, ranks, np.abs(theirs - np.arange(len(own)))).sum(1)
        best = int(distance.argmin())
        return langs[best], float(1 - distance[best] / (ranks * len(own)))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [nearest(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(predict, "doc_id long, lang_pred string, score double")
