"""Reports and alarms over log lines and metric points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as V
from ..functions.dates import bin_start
from ..functions.text import contains_any, glob_parse

_STATISTICS = {"sum": F.sum, "avg": F.avg}


EXACT = "decimal(28,9)"


def exact_sum(column: Column | str) -> Column:
    """Sum as a decimal of nine places, so that the order of tasks cannot move the last digit; ``cast("double")`` to show it."""
    return F.sum((F.col(column) if isinstance(column, str) else column).cast(EXACT))


def exact_mean(column: Column | str) -> Column:
    """Mean of an exact sum."""
    return F.try_divide(exact_sum(column).cast("double"), F.count(column))


def usage_by_bin(logs: DataFrame, ts: str, message: str, width: str = "5 minutes") -> DataFrame:
    """Mean tokens and total cost of model lines per bin, newest first."""
    tokens, cost = glob_parse(message, V.USAGE_GLOB, ["tokens", "cost"], ["tokens", "cost"])
    return (
        logs.where(F.rlike(F.col(message), F.lit(V.MODEL_LINE_PATTERN)))
        .select(bin_start(ts, width).alias("bin"), tokens, cost)
        .groupBy("bin")
        .agg(F.round(exact_mean("tokens"), 4).alias("avg_tokens"), F.round(exact_sum("cost").cast("double"), 4).alias("total_cost"))
        .orderBy(F.desc("bin"))
    )


def errors_by_bin(logs: DataFrame, ts: str, message: str, width: str = "1 hour") -> DataFrame:
    """Number of error lines per bin, newest first."""
    return (
        logs.where(F.rlike(F.col(message), F.lit(V.ERROR_PATTERN)))
        .groupBy(bin_start(ts, width).alias("bin"))
        .agg(F.count("*").alias("error_count"))
        .orderBy(F.desc("bin"))
    )


def records_by_category(logs: DataFrame, message: str) -> DataFrame:
    """Records and pages the source lines report per category, most records first.

    Lines of the kind that carry no figures form the null category.
    """
    parsed = glob_parse(message, V.CATEGORY_GLOB, ["category", "records", "pages"], ["records", "pages"])
    return (
        logs.where(F.rlike(F.col(message), F.lit(V.SOURCE_LINE_PATTERN)))
        .select(*parsed)
        .groupBy("category")
        .agg(
            F.sum("records").cast("bigint").alias("total_records"),
            F.sum("pages").cast("bigint").alias("total_pages"))
        .orderBy(F.desc_nulls_last("total_records"), F.asc_nulls_last("category"))
    )


def latest_errors(logs: DataFrame, ts: str, message: str, tie: str, n: int = 100) -> DataFrame:
    """The newest n error lines."""
    errors = logs.where(F.rlike(F.col(message), F.lit(V.LATEST_ERROR_PATTERN)))
    return errors.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def any_term_metric(message: str, terms: Sequence[str]) -> Column:
    """1 where the line holds any of the terms, else 0."""
    return contains_any(message, terms).cast("bigint")


def threshold_alerts(
    df: DataFrame, ts: str, metric: Column | str, width: str, statistic: str, comparison: str, threshold: float
) -> DataFrame:
    """Bins whose statistic breaches the threshold; a bin without points never does."""
    value = F.col(metric) if isinstance(metric, str) else metric
    binned = df.select(bin_start(ts, width).alias("bin"), value.alias("_metric")).where(F.col("_metric").isNotNull())
    stats = binned.groupBy("bin").agg(_STATISTICS[statistic]("_metric").alias("value"))
    breach = {">": F.col("value") > threshold, ">=": F.col("value") >= threshold}[comparison]
    return stats.where(breach)


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def width_micros(width: str) -> int:
    """Microseconds of a width like ``5 minutes``."""
    number, unit = width.split()
    return int(number) * _UNITS[unit.removesuffix("s")] * 1_000_000


def alarm_rules(spark: SparkSession, alarms: Mapping[str, tuple[str, str, str, str, float]] = V.ALARMS) -> DataFrame:
    """Alarms as rows: ``alarm, metric, width`` (microseconds), ``statistic`` (sum or avg), ``comparison, threshold``."""
    for name, (_, width, statistic, comparison, _) in alarms.items():
        if statistic not in _STATISTICS or comparison not in _COMPARISONS or width_micros(width) <= 0:
            raise ValueError(f"alarm {name}: unknown statistic, comparison or width")
    rows = F.array(*[
        F.struct(F.lit(name).alias("alarm"), F.lit(metric).alias("metric"), F.lit(width_micros(width)).cast("bigint").alias("width"),
                 F.lit(statistic).alias("statistic"), F.lit(comparison).alias("comparison"), F.lit(float(limit)).alias("threshold"))
        for name, (metric, width, statistic, comparison, limit) in alarms.items()])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


_COMPARISONS = {">": lambda v, t: v > t, ">=": lambda v, t: v >= t, "<": lambda v, t: v < t, "<=": lambda v, t: v <= t}


def breached(value: Column, comparison: Column, threshold: Column) -> Column:
    """Whether a value meets the comparison that a column names; an unknown one never is."""
    out = F.lit(False)
    for name, test in _COMPARISONS.items():
        out = F.when(comparison == name, test(value, threshold)).otherwise(out)
    return out


def evaluate_alarms(points: DataFrame, ts: str, metrics: Mapping[str, Column], rules: DataFrame) -> DataFrame:
    """``alarm, bin, value, threshold`` of every bin that breaches its rule, over any number of rules in one scan.

    ``metrics`` names a column for each metric that rules speak of; a row without a value is no point, and a bin without points never alarms. Each
    point becomes a row per rule of its metric, and one aggregate adds all of them up by (alarm, bin); sums are exact.
    """
    named = F.array(*[F.struct(F.lit(n).alias("metric"), c.cast(EXACT).alias("value")) for n, c in metrics.items()])
    long = points.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"), F.explode(F.filter(named, lambda m: m["value"].isNotNull())).alias("m"))
    placed = long.select("_us", "m.metric", "m.value").join(rules, "metric")
    bins = placed.groupBy("alarm", "statistic", "comparison", "threshold", (F.col("_us") - F.pmod("_us", "width")).alias("_bin")).agg(
        F.sum("value").cast("double").alias("total"), F.count("*").alias("points"))
    value = F.when(F.col("statistic") == "avg", F.col("total") / F.col("points")).otherwise(F.col("total"))
    return bins.withColumn("value", value).where(breached(F.col("value"), F.col("comparison"), F.col("threshold"))).select(
        "alarm", F.timestamp_micros("_bin").cast("timestamp_ntz").alias("bin"), "value", "threshold")


def daily_metrics(df: DataFrame, ts: str, sums: Sequence[str], averages: Sequence[str]) -> DataFrame:
    """Per day: the sum of some metrics and the mean of others."""
    return df.groupBy(F.col(ts).cast("date").alias("day")).agg(
        *[F.round(exact_sum(c).cast("double"), 2).alias(c) for c in sums], *[F.round(exact_mean(c), 4).alias(c) for c in averages])


def trailing_requests(
    df: DataFrame, ts: str, client: str, seconds: int = 60, chunk_seconds: int = 600
) -> DataFrame:
    """client, ts, requests and the number of requests in the ``seconds`` up to and including each ts.

    A request exactly ``seconds`` old no longer counts. Requests of one client at one
    instant are first added up; then each client's time line is cut into chunks, so one busy client is
    spread over many tasks. Each count is a running sum of what comes and what expires: every point enters its
    chunk and leaves the one it expires in, which it enters too if that is a later one. So no row looks at the others of its span.
    """
    span = seconds * 1_000_000
    chunk = max(chunk_seconds * 1_000_000, span)

    def chunk_of(us: Column) -> Column:
        return us - F.pmod(us, F.lit(chunk))

    points = (
        df.groupBy(F.col(client).alias("client"), F.col(ts).alias("ts")).agg(F.count("*").alias("requests"))
        .withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
        .where(F.col("_us").isNotNull())
    )
    home, expires = chunk_of(F.col("_us")), F.col("_us") + span
    last = chunk_of(expires)

    def change(at: Column, chunk: Column, by: Column, is_point: bool) -> Column:
        return F.struct(chunk.alias("_home"), at.alias("_at"), by.alias("_by"), F.lit(is_point).alias("_is_point"))

    here = change(F.col("_us"), home, F.col("requests"), True)
    gone = change(expires, last, -F.col("requests"), False)
    changes = F.when(last == home, F.array(here, gone)).otherwise(
        F.array(here, change(F.col("_us"), last, F.col("requests"), False), gone))
    spread = points.select("client", "ts", "requests", F.inline(changes))
    w = Window.partitionBy("client", "_home").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        spread.withColumn("trailing", F.sum("_by").over(w))
        .where("_is_point")
        .select("client", "ts", "requests", "trailing")
    )


def rate_report(trailing: DataFrame, limit: int) -> DataFrame:
    """Per client: all requests, the highest trailing count, and requests made above the limit."""
    return trailing.groupBy("client").agg(
        F.sum("requests").alias("requests"),
        F.max("trailing").alias("peak"),
        F.coalesce(F.sum(F.when(F.col("trailing") > limit, F.col("requests"))), F.lit(0)).cast("bigint").alias("over_limit"),
    )
