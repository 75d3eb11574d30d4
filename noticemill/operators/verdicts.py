"""Stored verdicts: look-up with a lifetime, missing keys, costs and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import is_fresh
from ..functions.rates import per_item, percent
from ..functions.text import text_key
from ..functions.verdict_text import parse_verdict, repair_verdict, verdict_lines
from .dedup import latest_per_key


def parse_responses(df: DataFrame, response: str, repair: bool = True) -> DataFrame:
    """Adds decisao, categoria, confianca and justificativa from the response text."""
    df = df.withColumn("_lines", verdict_lines(response))
    df = df.withColumns(parse_verdict("_lines")).drop("_lines")
    if repair:
        df = df.withColumns(repair_verdict("decisao", "confianca", "justificativa"))
    return df


def fresh_verdicts(cache: DataFrame, run_ts: Column, ttl_hours: int = 24, stored_at: str = "stored_at") -> DataFrame:
    """The newest verdict of each key, where it has not expired."""
    newest = latest_per_key(cache, ["key"], [F.col(stored_at).desc_nulls_last()])
    return newest.where(is_fresh(stored_at, run_ts, ttl_hours))


def with_key(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("key", text_key(text))


def cache_lookup(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Left look-up of fresh verdicts by key, with a cached flag.

    ``verdicts`` has one row per key, so a text that many rows share is skew on the left
    side only; adaptive execution splits it.
    """
    marked = verdicts.withColumn("cached", F.lit(True))
    return df.join(marked, "key", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


def uncached_keys(df: DataFrame, text: str, verdicts: DataFrame) -> DataFrame:
    """One row (key, text) per distinct key without a fresh verdict: the work for the model.

    Of texts that share a key the least one stands for all. Keys alone are compared with the
    verdicts; only texts of missing keys are reduced. Few missing keys are broadcast at run time, so
    the other texts never travel.
    """
    missing = df.select("key").distinct().join(verdicts.select("key"), "key", "left_anti")
    return df.join(missing, "key", "left_semi").groupBy("key").agg(F.min(text).alias("text"))


def with_cost(calls: DataFrame, prices: DataFrame, model: str, input_tokens: str, output_tokens: str) -> DataFrame:
    """Cost of each call by its model's prices per thousand tokens; an unknown model costs 0."""
    price = prices.select(F.col("model").alias("_m"), F.col("input_price").alias("_in"), F.col("output_price").alias("_out"))
    cost = F.col(input_tokens) / 1000 * F.col("_in") + F.col(output_tokens) / 1000 * F.col("_out")
    return (
        calls.join(price, F.col(model) == F.col("_m"), "left")
        .withColumn("cost_usd", F.coalesce(cost, F.lit(0.0)))
        .drop("_m", "_in", "_out")
    )


def usage_stats(
    calls: DataFrame, decision: str, tokens: str, cost: str, seconds: str, cached: str, error: str, cache_size: Column
) -> DataFrame:
    """One row of model-usage figures over a call log.

    A cached row is a hit and no query; a failed query counts as a query and as nothing
    else. The mean time is over the successful queries.
    """
    hit, failed = F.col(cached), F.col(error)
    query = ~hit
    done = query & ~failed

    def count_if(cond: Column) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    sums = calls.agg(
        count_if(query).alias("total_queries"),
        count_if(done & (F.col(decision) == V.APPROVE)).alias("aprovados"),
        count_if(done & (F.col(decision) != V.APPROVE)).alias("rejeitados"),
        count_if(hit).alias("cache_hits"),
        count_if(query).alias("cache_misses"),
        F.coalesce(F.sum(F.when(done, F.col(tokens))), F.lit(0)).cast("bigint").alias("total_tokens"),
        F.coalesce(F.sum(F.when(done, F.col(cost))), F.lit(0.0)).alias("_cost"),
        F.avg(F.when(done, F.col(seconds))).alias("_seconds"),
        count_if(query & failed).alias("errors"),
        cache_size.alias("cache_size"),
    )
    queries = F.col("total_queries")
    return sums.select(
        "total_queries",
        "aprovados",
        "rejeitados",
        percent(F.col("aprovados"), queries).alias("approval_rate_percent"),
        "cache_hits",
        "cache_misses",
        percent(F.col("cache_hits"), F.col("cache_hits") + F.col("cache_misses")).alias("cache_hit_rate_percent"),
        "total_tokens",
        per_item(F.col("total_tokens"), queries, 2).alias("avg_tokens_per_query"),
        F.round("_cost", 4).alias("total_cost_usd"),
        per_item(F.col("_cost"), queries, 4).alias("avg_cost_per_query"),
        F.round(F.coalesce("_seconds", F.lit(0.0)), 3).alias("avg_response_time_seconds"),
        "errors",
        "cache_size",
    )
