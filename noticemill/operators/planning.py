"""What is left to load: dates, categories and pages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import compact_date


def date_span(
    today: date,
    start: date,
    last_loaded: date | None = None,
    historical: bool = False,
    only: date | None = None,
    catch_up: bool = False,
) -> tuple[date, date] | None:
    """First and last date to load, or None when nothing is due.

    An explicit date wins. A historical run, or one without state, goes from ``start`` to
    today. Otherwise yesterday alone is due, or with ``catch_up`` every day after the last.
    """
    if only is not None:
        return only, only
    if historical or last_loaded is None:
        return (start, today) if start <= today else None
    if catch_up:
        first = last_loaded + timedelta(days=1)
        return (first, today) if first <= today else None
    yesterday = today - timedelta(days=1)
    return (yesterday, yesterday) if yesterday > last_loaded else None


def plan_dates(spark: SparkSession, span: tuple[date, date] | None) -> DataFrame:
    """One row per date of the span."""
    one = spark.range(1)
    if span is None:
        return one.where("false").select(F.lit(None).cast("date").alias("date"))
    first, last = (F.lit(d.isoformat()).cast("date") for d in span)
    return one.select(F.explode(F.sequence(first, last)).alias("date"))


def pending_dates(planned: DataFrame, processed: DataFrame) -> DataFrame:
    """Planned dates that are not processed yet."""
    return planned.join(processed.select("date").distinct(), "date", "left_anti")


def page_manifest(
    dates: DataFrame, categories: Sequence[str], totals: DataFrame, page_size: int = 50
) -> DataFrame:
    """One row per page to fetch: date, category, page, and the request's compact dates.

    ``totals`` has date, category and pages; a pair without pages gives no row.
    """
    work = dates.select("date", F.explode(F.lit(list(categories))).alias("category"))
    return (
        work.join(totals.where(F.col("pages") > 0), ["date", "category"])
        .select(
            "date",
            "category",
            compact_date("date").alias("start"),
            compact_date("date").alias("end"),
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pages").cast("bigint"))).alias("page"),
            F.lit(page_size).cast("bigint").alias("page_size"),
        )
    )
