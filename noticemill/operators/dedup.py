"""Unions, ordered de-duplication, upserts and set differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of each key; null keys are equal to each other.

    Spark keeps one row per key in every map task before the shuffle (WindowGroupLimit),
    so a key that holds a large part of all rows costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def dedup_keep_last(
    df: DataFrame, candidate_keys: Sequence[str], order: Sequence[str], require_all: bool = True
) -> DataFrame:
    """Keeps the last row, in ``order``, of each combination of the keys the frame has.

    With ``require_all`` a missing candidate is an error: fewer keys would merge rows that
    differ. Without it the keys present are used, and with none the frame stays as it is.
    """
    keys = [k for k in candidate_keys if k in df.columns]
    if require_all and len(keys) < len(candidate_keys):
        raise ValueError(f"missing key columns: {sorted(set(candidate_keys) - set(keys))}")
    if not keys:
        return df
    return latest_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def upsert_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, and all new rows."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_anti")
