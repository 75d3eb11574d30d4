"""Paged JSON envelopes: landed payloads to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_col


def envelope_schema(record: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("data", T.ArrayType(record)),
        T.StructField("totalPaginas", T.LongType()),
        T.StructField("totalRegistros", T.LongType()),
    ])


def read_envelopes(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """One row per landed envelope file line; folder columns (date=, category=) come along."""
    return spark.read.schema(envelope_schema(record)).json(path)


def parse_envelopes(df: DataFrame, payload: str, record: T.StructType) -> DataFrame:
    """The envelope fields of a JSON text column."""
    parsed = F.from_json(as_col(payload), envelope_schema(record))
    return df.withColumn("_envelope", parsed).select(
        *[c for c in df.columns if c != payload], "_envelope.data", "_envelope.totalPaginas", "_envelope.totalRegistros")


def explode_envelopes(envelopes: DataFrame) -> DataFrame:
    """One row per record; an envelope without data gives none."""
    other = [c for c in envelopes.columns if c not in ("data", "totalPaginas", "totalRegistros")]
    return envelopes.select(*other, F.explode("data").alias("record")).select(*other, "record.*")


def envelope_totals(envelopes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pages and records an envelope announces, 0 where it does not, per key."""
    return envelopes.groupBy(*keys).agg(
        F.max(F.coalesce("totalPaginas", F.lit(0))).alias("pages"),
        F.max(F.coalesce("totalRegistros", F.lit(0))).alias("records"),
    )
