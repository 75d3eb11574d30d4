"""Reports over the contract table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.rates import percent, ratio
from ..functions.text import contains_any


AMOUNT = "decimal(18,2)"


def mean(amount: Column) -> Column:
    """Mean to two places, halves away from zero, rounded once: whole cents are summed and divided
    without remainder, so neither task order nor a middle step can move the last place."""
    cents, n = F.sum((amount.cast(AMOUNT) * 100).cast("bigint")), F.count(amount)
    top, bottom = 2 * F.abs(cents) + n, 2 * n
    return F.when(n > 0, F.signum(cents) * F.round((top - top % bottom) / bottom) / 100)


def total(amount: Column | str) -> Column:
    """Exact sum of amounts in cents."""
    return F.sum((F.col(amount) if isinstance(amount, str) else amount).cast(AMOUNT)).cast("double")


def in_partition(df: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one month; on a partitioned table this prunes folders."""
    return df.where((F.col("year") == year) & (F.col("month") == month))


def in_month(df: DataFrame, ts: str, year: int, month: int) -> DataFrame:
    """Rows of one month by a range on the time column itself, which the scan can use."""
    first = f"{year:04d}-{month:02d}-01"
    start = F.lit(first).cast("timestamp_ntz")
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 MONTH")))


def row_total(df: DataFrame, out: str = "total") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def daily_profile(df: DataFrame, day: str, amount: str) -> DataFrame:
    """Rows and mean amount per day, in date order."""
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(day)
        .agg(F.count("*").alias("records"), mean(F.col(amount)).alias("mean_amount"))
        .orderBy(F.asc_nulls_last(day))
    )


def category_totals(df: DataFrame, category: str, amount: str) -> DataFrame:
    """Rows and amount per category, largest first."""
    return (
        df.groupBy(category)
        .agg(F.count("*").alias("contracts"), total(amount).alias("amount"))
        .orderBy(F.desc("contracts"), F.asc_nulls_last(category))
    )


def top_by_amount(df: DataFrame, amount: str, tie: str, n: int = 10) -> DataFrame:
    """The n rows of highest amount, null amounts last, ties by key."""
    return df.orderBy(F.desc_nulls_last(amount), F.asc(tie)).limit(n)


def reason_breakdown(df: DataFrame, flag: str, reason: str) -> DataFrame:
    return (
        df.groupBy(flag, reason)
        .agg(F.count("*").alias("quantity"))
        .orderBy(F.desc("quantity"), F.asc_nulls_last(flag), F.asc_nulls_last(reason))
    )


def fact_summary(df: DataFrame, keys: Sequence[str], row_id: str, amount: str) -> DataFrame:
    """Rows with an id, total and mean amount per combination of keys."""
    return df.groupBy(*keys).agg(
        F.count(row_id).alias("contracts"),
        total(amount).alias("amount"),
        mean(F.col(amount)).alias("mean_amount"),
    )


def count_where(cond: Column, row_id: str) -> Column:
    """Count of ids among the rows that meet a condition."""
    return F.count(F.when(cond, F.col(row_id)))


def sum_where(cond: Column, amount: str) -> Column:
    return total(F.when(cond, F.col(amount)))


def avg_where(cond: Column, amount: str) -> Column:
    return mean(F.when(cond, F.col(amount)))


def approval_ratio(df: DataFrame, approved: Column, row_id: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of ids that are approved, over all rows or per key."""
    share = F.round(ratio(count_where(approved, row_id), F.count(row_id)), 6).alias("approval_ratio")
    return df.groupBy(*keys).agg(share) if keys else df.agg(share)


def share_of_total(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Count per key and its share of the count over everything.

    The total is a sum over the grouped counts in a scalar subquery: the grouped shuffle is
    reused and no window gathers the groups in one task.
    """
    counts = df.groupBy(key).agg(F.count(row_id).alias("contracts"))
    total = counts.agg(F.sum("contracts")).scalar()
    return counts.select(key, "contracts", F.round(ratio(F.col("contracts"), total), 6).alias("share"))


def period_growth(df: DataFrame, period: str, amount: str) -> DataFrame:
    """Amount per period, summed exactly in cents, and its ratio to the period before; the first has none.

    The window runs over the grouped rows only: one per period.
    """
    sums = df.groupBy(period).agg(total(amount).alias("_sum"))
    before = F.lag("_sum").over(Window.orderBy(period))
    return sums.select(
        period, F.round("_sum", 2).alias("amount"), F.round(F.try_divide(F.col("_sum"), before), 6).alias("growth"))


def distinct_dimension(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def batch_verdicts(
    df: DataFrame, text: str, amount: str, keywords: Sequence[str], threshold: float, reason: str
) -> DataFrame:
    """Adds on_topic, high_value, approved and reasoning: any keyword in the lower-cased text AND a minimum amount."""
    return (
        df.withColumn("on_topic", contains_any(F.lower(F.col(text)), keywords))
        .withColumn("high_value", F.coalesce(F.col(amount) >= threshold, F.lit(False)))
        .withColumn("approved", F.col("on_topic") & F.col("high_value"))
        .withColumn(
            "reasoning",
            F.format_string(
                reason, F.initcap(F.col("on_topic").cast("string")), F.initcap(F.col("high_value").cast("string"))),
        )
    )


def funnel_stats(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row, or one per combination of ``keys``, on a two-stage filter: needs text_empty, stage1_passed, stage2_passed, included.

    Empty texts are rejected in stage 1 but spare no model call, as none was due.
    """
    def count_if(cond: Column) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    first, second, kept = F.col("stage1_passed"), F.col("stage2_passed"), F.col("included")
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("total_analisados"),
        count_if(first).alias("etapa1_aprovados"),
        count_if(~first).alias("etapa1_rejeitados"),
        count_if(first & second).alias("etapa2_aprovados"),
        count_if(first & ~second).alias("etapa2_rejeitados"),
        count_if(kept).alias("filtrados_aprovados"),
        count_if(~kept).alias("filtrados_rejeitados"),
        count_if(~first & ~F.col("text_empty")).alias("llm_economizados"),
    )
    total = F.col("total_analisados")
    return sums.select(
        "*",
        percent(F.col("filtrados_aprovados"), total).alias("taxa_aprovacao_final_percent"),
        percent(F.col("etapa1_aprovados"), total).alias("taxa_etapa1_aprovacao_percent"),
        percent(F.col("llm_economizados"), total).alias("taxa_economia_llm_percent"),
    )


def hits_by_key(df: DataFrame, keys: Sequence[str], column: str, n: int, out: str) -> DataFrame:
    """Per combination of ``keys`` the ``n`` values of ``column`` with most rows, as an array of (name, matches); ties by name."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_name")).agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_n"), F.asc("_name")))
    best = counts.withColumn("_place", place).where(F.col("_place") <= n)
    ranked = F.array_sort(F.collect_list(F.struct("_place", F.col("_name").alias("name"), F.col("_n").alias("matches"))))
    return best.groupBy(*keys).agg(F.transform(ranked, lambda r: F.struct(r["name"].alias("name"), r["matches"].alias("matches"))).alias(out))


def run_totals(df: DataFrame, day: str) -> DataFrame:
    """Rows per date, with the total over all non-empty days beside each.

    The total is a scalar subquery over the grouped counts, so their shuffle is reused.
    """
    counts = df.groupBy(F.col(day).alias("date")).agg(F.count("*").alias("records"))
    return counts.withColumn("total_records", counts.agg(F.sum("records")).scalar())
