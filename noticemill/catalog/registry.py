"""Registry of queries over the shared test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_frame(spark: SparkSession, rows: list[dict], fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    """A small parameter table; Spark keeps it in the plan, so reading it needs no job."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, pa.schema(fields)))


def day_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd")


def time_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"
