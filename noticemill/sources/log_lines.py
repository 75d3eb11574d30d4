"""Log lines as (ts, message), batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOG_SCHEMA = "ts timestamp, message string"


def read_logs(spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(LOG_SCHEMA).format(fmt).load(path)
