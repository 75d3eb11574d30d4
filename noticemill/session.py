"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# A lexicon at or below this many entries is planned as a constant; a larger one is joined.
MAX_INLINE_ENTRIES = 2000


def build_session(master: str | None = None, app_name: str = "noticemill", **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Shuffle partitions are left to adaptive execution: start from a high number on
    a cluster and let small ones be merged.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="noticemill-")


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local session (a test run) gets a temporary folder; on
    a cluster, whose machines do not share one, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return _local_root(spark.sparkContext.applicationId)


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared work folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
