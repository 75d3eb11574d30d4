"""Incremental load as a stream: the checkpoint is the list of what has been processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import partition_columns
from ..sources.dataset import file_names, path_exists

LEDGER = "batch_id bigint, date date, rows bigint"


def load_new_files(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], day: str, target: str, checkpoint: str,
    timeout_seconds: int | None = None, ledger: str | None = None,
) -> None:
    """Runs ``transform`` over all files not seen before and writes them by day.

    Each micro-batch owns a batch= folder inside the day, so a batch that is repeated after
    a failure replaces only its own rows, and two batches of one day do not erase each other. With ``ledger`` each batch also
    leaves an entry there, written after its rows: ``rows`` per day, and how many came in. ``read_loaded`` sees the rows of
    batches with an entry only, so a batch that was lost between its rows and its entry, or between its entry and the
    checkpoint, is run again and shows up once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = transform(batch).withColumns({**partition_columns(day), "batch": F.lit(batch_id)})
        (
            rows.hint("rebalance", "year", "month", "day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("year", "month", "day", "batch")
            .parquet(target)
        )
        if ledger is None:
            return
        days = spark.createDataFrame([], LEDGER)
        if path_exists(spark, target):
            # Folder columns and footers of this batch alone: nothing is transformed or read a second time.
            stored = spark.read.parquet(target).where(F.col("batch") == batch_id).groupBy("year", "month", "day").agg(F.count("*").alias("rows"))
            days = stored.select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.make_date("year", "month", "day").alias("date"), "rows")
        empty = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(None).cast("date").alias("date"), F.lit(0).cast("bigint").alias("rows"))
        days.unionByName(empty).coalesce(1).write.mode("overwrite").json(f"{ledger}/{batch_id:09d}")

    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if not query.awaitTermination(timeout_seconds) if timeout_seconds else query.awaitTermination():
        query.stop()
        raise TimeoutError("stream did not finish in time")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``batch_id, date, rows`` of finished batches; a batch has a row without date too, so one that kept nothing is listed."""
    done = [n for n in file_names(spark, ledger) if path_exists(spark, f"{ledger}/{n}/_SUCCESS")]
    return spark.read.schema(LEDGER).json([f"{ledger}/{n}" for n in done]) if done else spark.createDataFrame([], LEDGER)


def read_loaded(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """The rows of finished batches; those of a batch that has not been entered are left out."""
    done = [r["batch_id"] for r in read_ledger(spark, ledger).select("batch_id").distinct().collect()]
    return spark.read.parquet(target).where(F.col("batch").isin(done)).drop("batch")  # prunes folders


def run_state(spark: SparkSession, ledger: str) -> DataFrame:
    """One row: batches, rows, and the first and last day with rows, out of the ledger."""
    return read_ledger(spark, ledger).agg(
        F.countDistinct("batch_id").alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"))
