"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept: toxic documents go, then exact copies, then all but one
document of each near-duplicate group; the rest is mixed to the source weights (a document may stay
several times or not at all) and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticemill.llm.catalog import toxicity_model
from noticemill.llm.common import written
from noticemill.llm.exact_dedup import drop_copies
from noticemill.llm.mixing import take
from noticemill.llm.near_dedup import keep_one
from noticemill.llm.packing import pack_documents
from noticemill.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, toxicity_model(spark, docs, sf_dir), bound=0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, width=5, percent=80, bands=34, rows=5)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return take(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, capacity=2048, vocabulary="byte_bpe_50k", end_id=0)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]
# SQL can express neither the learned scores nor the draws; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
