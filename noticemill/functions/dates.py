"""Date columns: parsing, calendar parts, partition keys, expiry, bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import as_col


def parse_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of a text, null where it is not one."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("date")


def partition_columns(day: Column | str) -> dict[str, Column]:
    """year, month and day as integers, for partitioned writes."""
    day = as_col(day)
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def month_key(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyyy-MM")


def compact_date(day: Column | str) -> Column:
    """yyyyMMdd, as page requests and file names carry it."""
    return F.date_format(as_col(day), "yyyyMMdd")


def is_fresh(stored_at: Column | str, run_ts: Column, ttl_hours: int) -> Column:
    """True while run time is before storage time plus the lifetime; a missing time is never fresh."""
    expiry = as_col(stored_at) + F.expr(f"INTERVAL {int(ttl_hours)} HOURS")
    return F.coalesce(run_ts < expiry, F.lit(False))


def is_older_than(file_date: Column | str, run_ts: Column, days: int) -> Column:
    """True where midnight of the file's date is before run time minus the days."""
    cutoff = run_ts - F.expr(f"INTERVAL {int(days)} DAYS")
    return as_col(file_date).cast("timestamp_ntz") < cutoff.cast("timestamp_ntz")


def bin_start(ts: Column | str, width: str) -> Column:
    """Start of the tumbling bin of a time."""
    return F.window(as_col(ts), width)["start"]


def calendar(df: DataFrame, day: str) -> DataFrame:
    """One row per distinct date with its calendar parts; null dates are left out."""
    d = F.col("date")
    return (
        df.select(F.col(day).cast("date").alias("date"))
        .where(d.isNotNull())
        .distinct()
        .select(
            d,
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            F.date_format(d, "MMM yyyy").alias("month_name"),
            F.dayofmonth(d).alias("day"),
            F.weekday(d).alias("weekday"),
            F.weekofyear(d).alias("iso_week"),
            F.quarter(d).alias("quarter"),
            F.concat(F.lit("Q"), F.quarter(d), F.lit("-"), F.year(d)).alias("quarter_year"),
        )
    )
