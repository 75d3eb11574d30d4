"""Log bins and alarms over a stream of log lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import glob_parse
from ..operators.logs import breached, exact_mean, exact_sum


def usage_bins(logs: DataFrame, ts: str, message: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Mean tokens and total cost of model lines per bin; lines later than ``late`` are dropped in append mode."""
    tokens, cost = glob_parse(message, V.USAGE_GLOB, ["tokens", "cost"], ["tokens", "cost"])
    lines = logs.where(F.rlike(F.col(message), F.lit(V.MODEL_LINE_PATTERN)))
    return (
        lines.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late)
        .select(F.col(ts), tokens, cost)
        .groupBy(F.window(ts, width))
        .agg(F.round(exact_mean("tokens"), 4).alias("avg_tokens"), F.round(exact_sum("cost").cast("double"), 4).alias("total_cost"))
        .select(F.col("window.start").alias("bin"), "avg_tokens", "total_cost")
    )


def alert_bins(
    df: DataFrame, ts: str, metric: Column, width: str, comparison: str, threshold: float, late: str = "10 minutes"
) -> DataFrame:
    """Closed or changed bins whose summed metric breaches the threshold."""
    sums = (
        df.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, late)
        .select(F.col(ts), metric.alias("_metric"))
        .groupBy(F.window(ts, width))
        .agg(F.sum("_metric").alias("value"))
        .select(F.col("window.start").alias("bin"), "value")
    )
    return sums.where(F.col("value") > threshold if comparison == ">" else F.col("value") >= threshold)


def alarm_windows(
    df: DataFrame, ts: str, width: str, alarms: Mapping[str, tuple[Column, str, str, float]], late: str = "10 minutes"
) -> DataFrame:
    """``alarm, bin, value`` of the bins that breach; ``alarms`` names (metric, sum or avg, comparison, threshold) of one bin width.

    All alarms share one state: two figures a metric and open bin. In append mode a bin comes out once, after the watermark has
    passed its end, and its state goes; rows later than ``late`` behind the newest are dropped and counted by the query's progress (see
    ``late_groups``). A null metric is no point; a bin without points never alarms.
    """
    stats = []
    for name, (metric, _, _, _) in alarms.items():
        stats += [exact_sum(metric).cast("double").alias(f"{name}_sum"), F.count(metric).alias(f"{name}_n")]
    bins = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, width)).agg(*stats)
    values = F.array(*[
        F.struct(F.lit(name).alias("alarm"), F.lit(op).alias("comparison"), F.lit(float(limit)).alias("threshold"),
                 (F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n")) if statistic == "avg" else F.col(f"{name}_sum")).alias("value"))
        for name, (_, statistic, op, limit) in alarms.items()])
    rows = bins.select(F.col("window.start").alias("bin"), F.explode(values).alias("a"))
    return rows.where(breached(F.col("a.value"), F.col("a.comparison"), F.col("a.threshold"))).select("a.alarm", "bin", "a.value")


def late_groups(progress: list[dict]) -> int:
    """Rows that came too late, out of a query's ``recentProgress``; rows of one task and bin are one by then."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in p["stateOperators"])


def open_state(progress: list[dict]) -> int:
    """State rows that the last batch left behind."""
    return sum(op["numRowsTotal"] for op in progress[-1]["stateOperators"]) if progress else 0
