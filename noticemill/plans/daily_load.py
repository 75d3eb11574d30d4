"""Incremental load of landed envelopes into the daily dataset."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.planning import date_span, pending_dates, plan_dates
from ..operators.reports import funnel_stats, hits_by_key
from ..session import work_path
from ..sources.dataset import delete_path, path_exists, read_dataset, with_control_columns, write_daily
from ..sources.json_store import load_json, upsert_json

COUNTS = ("total_analisados", "etapa1_aprovados", "etapa1_rejeitados", "etapa2_aprovados", "etapa2_rejeitados",
          "filtrados_aprovados", "filtrados_rejeitados", "llm_economizados")
RATES = ("taxa_aprovacao_final_percent", "taxa_etapa1_aprovacao_percent", "taxa_economia_llm_percent")
STATS_SCHEMA = ", ".join([
    *[f"{c}: bigint" for c in COUNTS], *[f"{c}: double" for c in RATES], "filtro_hibrido_ativo: boolean",
    "top_grupos: array<struct<name: string, matches: bigint>>", "top_termos: array<struct<name: string, matches: bigint>>",
    "llm_stats: struct<verdicts: bigint, cache_hits: bigint, total_tokens: bigint>"])
LOG_SCHEMA = f"date date, timestamp string, records bigint, filepath string, filter_stats struct<{STATS_SCHEMA}>"
MARKS = ("included", "text_empty", "stage1_passed", "stage2_passed", "matched_group", "matched_term")


def processed_dates(spark: SparkSession, store: str) -> DataFrame:
    """Dates the extraction log holds, loaded or empty."""
    log = load_json(spark, f"{store}/metadata/extraction_log", LOG_SCHEMA)
    if log is None:
        return spark.range(0).select(
            F.lit(None).cast("date").alias("date"), F.lit(None).cast("bigint").alias("records"))
    return log.select("date", "records")


def last_loaded(processed: DataFrame) -> date | None:
    """Newest date with records; an empty day does not move it."""
    return processed.where("records > 0").agg(F.max("date")).first()[0]


def run_state(log: DataFrame) -> DataFrame:
    """One row on a log of (date, records): last date with records, all records, processed and empty dates."""
    loaded = F.col("records") > 0
    return log.agg(
        F.max(F.when(loaded, F.col("date"))).alias("last_extraction_date"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("total_records_extracted"),
        F.count("date").alias("processed_dates"),
        F.count(F.when(~loaded, F.lit(1))).alias("empty_dates"),
    )


def judge_once(wanted: DataFrame, judge: Callable[[DataFrame], DataFrame], day: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Judges every row and writes the outcome once; returns the kept rows and the marks of all rows, both read from there.

    A kept row is written whole, a rejected one as its day and marks alone, so the side table costs next to nothing and
    the source is read and judged once, however often a task is repeated.
    """
    judged = judge(wanted)
    call = [F.col(f"details.{c}").alias(c) if c in judged.schema["details"].dataType.fieldNames() else F.lit(None).cast(kind).alias(c)
            for c, kind in (("llm_cached", "boolean"), ("llm_tokens_used", "bigint"))]
    whole = F.struct(*[F.col(f"`{c}`") for c in judged.columns])
    marks = F.struct(F.col(day).alias("day"), *[F.col(m) for m in MARKS], *call)
    judged.select(
        F.col("included").alias("kept"), marks.alias("marks"), F.when(F.col("included"), whole).alias("whole"),
    ).write.partitionBy("kept").parquet(path)
    # A declared schema: a run without rows leaves no file to take one from.
    kind = T.StructType([*judged.select(marks.alias("marks"), whole.alias("whole")).schema.fields, T.StructField("kept", T.BooleanType())])
    stored = wanted.sparkSession.read.schema(kind).parquet(path)
    return stored.where("kept").select("whole.*"), stored.select("marks.*")


def load_statistics(marks: DataFrame, n: int = 10) -> DataFrame:
    """``date, filter_stats`` per day of the marks: the funnel, its rates, the groups and terms met most, figures of the verdicts."""
    count_if = lambda c: F.count(F.when(c, F.lit(1)))
    called = F.col("stage2_passed").isNotNull()
    calls = marks.groupBy("day").agg(
        F.struct(count_if(called).alias("verdicts"), count_if(F.col("llm_cached")).alias("cache_hits"),
                 F.coalesce(F.sum("llm_tokens_used"), F.lit(0).cast("bigint")).alias("total_tokens")).alias("llm_stats"),
        (count_if(called) > 0).alias("filtro_hibrido_ativo"))
    out = funnel_stats(marks, ["day"]).join(calls, "day")
    for column, name in (("matched_group", "top_grupos"), ("matched_term", "top_termos")):
        out = out.join(hits_by_key(marks, ["day"], column, n, name), "day", "left")
    none = F.array().cast("array<struct<name: string, matches: bigint>>")
    return out.select(F.col("day").alias("date"), F.struct(
        *COUNTS, *RATES, "filtro_hibrido_ativo", F.coalesce("top_grupos", none).alias("top_grupos"),
        F.coalesce("top_termos", none).alias("top_termos"), "llm_stats").alias("filter_stats"))


def run_daily_load(
    spark: SparkSession,
    store: str,
    records: DataFrame,
    day: str,
    transform: Callable[[DataFrame], DataFrame],
    run_ts: datetime,
    start: date,
    historical: bool = False,
    only: date | None = None,
    catch_up: bool = False,
    judge: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Loads every due, unprocessed date of ``records`` and returns its log entries.

    ``judge`` marks rows as ``hybrid_filter`` does; the rows it includes then go through ``transform``, and the log holds each
    date's filter statistics. Without it ``transform`` alone decides and there are none.

    All dates run as one plan. A due date without kept records is logged with 0 and not
    tried again. Data is written before the log, both by folder replacement, so a run that
    is lost half-way is repeated with the same result.
    """
    done = processed_dates(spark, store)
    span = date_span(run_ts.date(), start, last_loaded(done), historical, only, catch_up)
    stamp = F.date_format(F.lit(run_ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    if span is None:  # nothing is due: what this run has logged before, if anything
        log = load_json(spark, f"{store}/metadata/extraction_log", LOG_SCHEMA)
        return spark.createDataFrame([], LOG_SCHEMA) if log is None else log.where(F.col("timestamp") == stamp)
    due = pending_dates(plan_dates(spark, span), done)
    wanted = records.join(due.withColumnRenamed("date", day), day, "left_semi")
    # Bounds on the day reach the scan; the semi join alone would not.
    wanted = wanted.where(F.col(day).between(F.lit(span[0]), F.lit(span[1])))
    clock = F.lit(run_ts).cast("timestamp")
    target = f"{store}/raw-data"
    staging, statistics = work_path(spark, "judged"), None
    if judge is not None:
        wanted, marks = judge_once(wanted, judge, day, staging)
        statistics = load_statistics(marks)
    write_daily(with_control_columns(transform(wanted), clock, day), target, day)

    entries = due.select("date")
    if path_exists(spark, target):
        # Only folder columns are read, and only the folders of the span.
        folder_date = F.make_date("year", "month", "day")
        stored = read_dataset(spark, target).where(folder_date.between(F.lit(span[0]), F.lit(span[1])))
        loaded = stored.groupBy(folder_date.alias("date")).agg(F.count("*").alias("records"))
        entries = entries.join(loaded, "date", "left")
    else:
        entries = entries.withColumn("records", F.lit(None).cast("bigint"))
    if statistics is None:
        entries = entries.withColumn("filter_stats", F.lit(None).cast(f"struct<{STATS_SCHEMA}>"))
    else:
        entries = entries.join(statistics, "date", "left")
    entries = entries.select(
        "date",
        stamp.alias("timestamp"),
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        F.concat(F.lit(target), F.date_format("date", "'/year='yyyy'/month='M'/day='d")).alias("filepath"),
        "filter_stats",
    )
    upsert_json(entries.withColumn("log_date", F.col("date")), f"{store}/metadata/extraction_log", ["log_date"])
    if judge is not None:
        delete_path(spark, staging)
    log = load_json(spark, f"{store}/metadata/extraction_log", LOG_SCHEMA)
    return log.where(F.col("timestamp") == stamp)
