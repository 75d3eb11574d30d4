"""Domain tables of the caller: code, name, description, active."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOMAIN_SCHEMA = "domain string, code string, name string, description string, active boolean"


def read_domains(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Domain name to its table, out of JSON lines; a line without ``active`` is active.

    The list of domain names is small by nature; the tables stay DataFrames.
    """
    lines = spark.read.schema(DOMAIN_SCHEMA).json(path).withColumn("active", F.coalesce("active", F.lit(True)))
    names = sorted(r["domain"] for r in lines.select("domain").distinct().collect())
    return {n: lines.where(F.col("domain") == n).drop("domain") for n in names}
