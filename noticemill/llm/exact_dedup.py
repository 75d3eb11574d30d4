"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step groups only what the step before could not tell apart. All steps are DataFrame
operations; counts are combined before their shuffles, so a text that a third of all rows
repeat sends one row a task, and the joins that bring counts back have one row a key on their
small side, so Spark can split a hot key on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import whole_rows


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64,
                 hash_all: bool = False) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical; a null text counts as empty. Of equal texts the
    largest id stays (``keep_id``); a null id stays only if the whole group has none.
    Rows that repeat an id are one document: they get the same verdict. ``text_sha256`` is null for
    texts that length or prefix already set apart, whose content is not hashed, unless ``hash_all`` asks for it.
    An empty table gives no rows; other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).alias("n"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix"),
        (F.sha2(text.cast("binary"), 256) if hash_all else text).alias("content"),
    )
    lengths = rows.groupBy("n").count().filter("count > 1").select("n")
    prefixes = (
        rows.select("n", "prefix").join(lengths, "n", "left_semi")
        .groupBy("n", "prefix").count().filter("count > 1").select("n", "prefix", F.lit(True).alias("open"))
    )
    rows = rows.join(prefixes, ["n", "prefix"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    if not hash_all:
        # Never null, so that no test of the hash for null is pushed below the join, where it would hash every text.
        full = F.coalesce(F.sha2(F.col("content").cast("binary"), 256), F.lit(""))
        rows = rows.withColumn("content", F.when(F.col("open"), full))
    groups = (
        rows.filter("open").groupBy("n", "content")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    )
    joined = rows.join(groups, ["n", "content"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("content").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stays; rows that repeat an id and a text become one row.

    Rows with a null id stay only if all rows of their text have none. Beside its row a text travels as a hash of 128 bits.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = whole_rows(docs, key=F.coalesce(F.col(id_col).cast("string"), F.lit("")), same=F.struct(F.xxhash64(text), F.xxhash64(F.lit(1), text)))
    stay = exact_groups(docs, id_col, text_col).filter("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"))
    return rows.join(stay.distinct(), "key", "left_semi").dropDuplicates(["key", "same"]).select("row.*")
