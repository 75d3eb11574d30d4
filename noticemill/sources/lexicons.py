"""Lexicon files: delimited pairs and JSON maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import LEXICON_MAP


def read_pairs(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """(group, term) of a delimited file with a header and, possibly, a byte-order mark."""
    return (
        spark.read.schema("group string, term string")
        .csv(path, sep=sep, header=True, enforceSchema=True, encoding="UTF-8")
        .where(F.col("group").isNotNull() & F.col("term").isNotNull())
    )


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """(group, group_pos, terms) of a JSON object of groups; no file or no object gives no rows."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.range(0).select(
            F.lit("").alias("group"), F.lit(0).cast("bigint").alias("group_pos"),
            F.array().cast("array<string>").alias("terms"))
    return explode_map(text.select(F.from_json("value", LEXICON_MAP).alias("lexicon")), "lexicon")


def explode_map(df: DataFrame, column: str) -> DataFrame:
    """A map of group to terms as (group, group_pos, terms)."""
    return df.select(F.posexplode(column).alias("pos", "group", "terms")).select(
        "group", F.col("pos").cast("bigint").alias("group_pos"), "terms")
