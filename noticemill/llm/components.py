"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links from larger to smaller ids."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u").select("v", "m").union(least.select("u", "m"))
    return joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest reachable node) for every node of ``links``, whose two columns are node ids.

    A hub with many links sends its minimum, not its neighbours, so no group is collected. Null
    ends and links to oneself count for nothing; a rerun of a lost task reads the last written round.
    """
    a, b = links.columns
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    now, before = written(now, "links"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = written(_small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct())
