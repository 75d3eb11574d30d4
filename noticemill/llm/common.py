"""What several operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def _test_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="noticemill-llm-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names.

    Only a local session without that setting (a test) gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = _test_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: its lineage ends here."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``doc_id`` (long) and ``text`` (null: empty) alone, so that no other name can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def id_crc(column: Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 2000, size: str = "32m") -> None:
    """Bounds what one Arrow batch holds, by rows and by bytes, so that very long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_rows(docs: DataFrame, **more: Column) -> DataFrame:
    """Every row as one column ``row`` beside ``more``, so that no column of ``docs`` can clash; ``row.*`` unpacks it."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])
