"""Small JSON tables: the extraction log, processed dates and other state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .dataset import path_exists


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def load_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The rows of a JSON dataset, or None where there is none."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schema).json(path)


def upsert_json(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Writes each key's rows to its own folder, replacing what that key had; other keys stay.

    Nothing is read back, so running it twice changes nothing.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .json(path)
    )
