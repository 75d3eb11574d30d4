"""Log and metric reports over events: every event becomes the log line of its type."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators import logs as LG
from ..session import work_path
from ..sources.log_lines import read_logs
from .registry import query, table, time_text

# Valid in both dialects. Tokens are the whole part of value; cost has two places.
MESSAGE = """CASE event_type
 WHEN 'view' THEN 'LLM APROVAR: objeto... (Confiança: 90%, Tokens: ' || CAST(floor(value) AS BIGINT) || ', Custo: $'
   || CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR(20)) || ')'
 WHEN 'purchase' THEN 'Modalidade ' || (user_id % 13) || ': ' || CAST(floor(value) AS BIGINT) || ' registros em ' || (user_id % 7) || ' páginas'
 WHEN 'error' THEN CASE WHEN user_id % 3 = 0 THEN 'ERROR na requisição' WHEN user_id % 3 = 1 THEN 'Traceback (most recent call last)'
   ELSE 'API 429 quota Exception' END
 WHEN 'click' THEN 'Modalidade sem dados'
 ELSE 'ok' END"""
LOG_SQL = f"WITH lg AS (SELECT event_id, ts, user_id, event_type, value, {MESSAGE} AS message FROM events)\n"


def log_lines(spark, sf):
    return table(spark, sf, "events").withColumn("message", F.expr(MESSAGE.replace("VARCHAR(20)", "STRING")))


USAGE_SQL = LOG_SQL + """
SELECT strftime(time_bucket(INTERVAL {width}, ts), '%Y-%m-%d %H:%M:%S') AS bin,
  round(sum(CAST(regexp_extract(message, 'Tokens: ([0-9]+), Custo: \\$([0-9.]+)', 1) AS DECIMAL(28, 9)))::DOUBLE / count(*), 4) AS avg_tokens,
  round(sum(CAST(regexp_extract(message, 'Tokens: ([0-9]+), Custo: \\$([0-9.]+)', 2) AS DECIMAL(28, 9)))::DOUBLE, 4) AS total_cost
FROM lg WHERE contains(message, 'LLM') GROUP BY 1"""


@query("log_5m", USAGE_SQL.format(width="5 MINUTES"))
def log_5m(spark, sf):
    return LG.usage_by_bin(log_lines(spark, sf), "ts", "message").withColumn("bin", time_text("bin"))


@query("log_errors_1h", LOG_SQL + """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS bin, count(*) AS error_count
FROM lg WHERE regexp_matches(message, 'ERROR|FATAL|Exception|Traceback') GROUP BY 1""")
def log_errors_1h(spark, sf):
    return LG.errors_by_bin(log_lines(spark, sf), "ts", "message").withColumn("bin", time_text("bin"))


@query("stored_logs", LOG_SQL + """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS bin, count(*) AS error_count
FROM lg WHERE regexp_matches(message, 'ERROR|FATAL|Exception|Traceback') GROUP BY 1""")
def stored_logs(spark, sf):
    """Log lines written as JSON files and read back as a log source."""
    path = work_path(spark, "logs")
    log_lines(spark, sf).select("ts", "message", "user_id").write.json(path)
    return LG.errors_by_bin(read_logs(spark, path), "ts", "message").withColumn("bin", time_text("bin"))


@query("log_by_category", LOG_SQL + r"""
SELECT nullif(regexp_extract(message, 'Modalidade (.*?): (-?[0-9]+) registros em (-?[0-9]+) páginas', 1), '') AS category,
  sum(TRY_CAST(regexp_extract(message, 'Modalidade (.*?): (-?[0-9]+) registros em (-?[0-9]+) páginas', 2) AS BIGINT))::BIGINT AS total_records,
  sum(TRY_CAST(regexp_extract(message, 'Modalidade (.*?): (-?[0-9]+) registros em (-?[0-9]+) páginas', 3) AS BIGINT))::BIGINT AS total_pages
FROM lg WHERE regexp_matches(message, 'API|requisição|Modalidade') GROUP BY 1""")
def log_by_category(spark, sf):
    return LG.records_by_category(log_lines(spark, sf), "message")


@query("latest_errors", LOG_SQL + """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, message FROM lg
WHERE regexp_matches(message, 'ERROR|FATAL|Exception') ORDER BY ts DESC, event_id DESC LIMIT 100""")
def latest_errors(spark, sf):
    return LG.latest_errors(log_lines(spark, sf), "ts", "message", "event_id").select(
        "event_id", time_text("ts").alias("at"), "message")


@query("metric_filter", LOG_SQL + """
SELECT strftime(time_bucket(INTERVAL 10 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS bin,
  sum(CASE WHEN contains(message, 'OpenAI') OR contains(message, 'API') OR contains(message, '429')
           OR contains(message, 'quota') OR contains(message, 'rate limit') THEN 1 ELSE 0 END)::BIGINT AS failures
FROM lg GROUP BY 1""")
def metric_filter(spark, sf):
    from ..functions.dates import bin_start

    lines = log_lines(spark, sf)
    return lines.groupBy(bin_start("ts", "10 minutes").alias("bin")).agg(
        F.sum(LG.any_term_metric("message", V.API_FAILURE_TERMS)).alias("failures")).withColumn("bin", time_text("bin"))


@query("threshold_alerts", LOG_SQL + """
SELECT 'errors' AS alarm, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS bin, count(*)::DOUBLE AS value
FROM lg WHERE regexp_matches(message, 'ERROR|FATAL|Exception|Traceback') GROUP BY 2 HAVING count(*) > 4
UNION ALL
SELECT 'failures', strftime(time_bucket(INTERVAL 5 MINUTES, ts), '%Y-%m-%d %H:%M:%S'), count(*)::DOUBLE
FROM lg WHERE event_type = 'error' GROUP BY 2 HAVING count(*) >= 1
UNION ALL
SELECT 'duration', strftime(time_bucket(INTERVAL 5 MINUTES, ts), '%Y-%m-%d %H:%M:%S'), round(avg(value), 4)
FROM lg GROUP BY 2 HAVING avg(value) > 100
UNION ALL
SELECT 'cost', strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S'), round(sum(value), 4)
FROM lg GROUP BY 2 HAVING sum(value) > 50""")
def threshold_alerts(spark, sf):
    rules = {
        "errors": ("error_count", "1 hour", "sum", ">", 4), "failures": ("failed", "5 minutes", "sum", ">=", 1),
        "duration": ("value", "5 minutes", "avg", ">", 100), "cost": ("value", "24 hours", "sum", ">", 50)}
    metrics = {
        "error_count": LG.any_term_metric("message", V.ERROR_TERMS), "failed": F.when(F.col("event_type") == "error", F.lit(1)),
        "value": F.col("value")}
    return _shown(LG.evaluate_alarms(log_lines(spark, sf), "ts", metrics, LG.alarm_rules(spark, rules)))


def _shown(alerts):
    return alerts.select("alarm", time_text("bin").alias("bin"), F.round("value", 4).alias("value"))


# Metric points of the alarms over the log lines, valid in both dialects.
POINTS = {
    "executions_failed": "CASE WHEN event_type = 'error' THEN 1 END",
    "execution_time_ms": "CASE WHEN event_type = 'purchase' THEN value * 120000 END",
    "tasks_failed": "CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 1 ELSE 0 END",
    "error_count": "CASE WHEN event_type = 'error' THEN 1 + user_id % 5 ELSE 0 END",
    "api_failure_count": "CASE WHEN event_type = 'error' THEN 6 WHEN event_type = 'purchase' THEN 2 END",
    "cost_usd": "CASE WHEN event_type = 'view' THEN CAST(CAST(value AS DECIMAL(12, 2)) AS DOUBLE) / 50 END",
}


def _alarm_sql():
    parts = []
    for name, (metric, width, statistic, comparison, limit) in V.ALARMS.items():
        total = f"sum(CAST({POINTS[metric]} AS DECIMAL(28, 9)))::DOUBLE"
        value = total if statistic == "sum" else f"{total} / count({POINTS[metric]})"
        parts.append(f"""SELECT '{name}' AS alarm, strftime(time_bucket(INTERVAL {width}, ts), '%Y-%m-%d %H:%M:%S') AS bin, round({value}, 4) AS value
FROM events GROUP BY 2 HAVING {value} {comparison} {limit}""")
    return " UNION ALL ".join(parts)


@query("alarm_table", _alarm_sql())
def alarm_table(spark, sf):
    metrics = {n: F.expr(e) for n, e in POINTS.items()}
    return _shown(LG.evaluate_alarms(table(spark, sf, "events"), "ts", metrics, LG.alarm_rules(spark)))


@query("daily_metrics", """
SELECT strftime(ts, '%Y-%m-%d') AS day, round(sum(value::DECIMAL(28, 9))::DOUBLE, 2) AS value,
  round(sum(user_id::DECIMAL(28, 9))::DOUBLE / count(*), 4) AS user_id FROM events GROUP BY 1""")
def daily_metrics(spark, sf):
    return LG.daily_metrics(table(spark, sf, "events"), "ts", ["value"], ["user_id"]).withColumn(
        "day", F.date_format("day", "yyyy-MM-dd"))


TRAILING_SQL = """
WITH p AS (SELECT {client} AS client, ts, count(*) AS requests FROM events GROUP BY 1, 2),
t AS (SELECT client, ts, requests, (sum(requests) OVER (PARTITION BY client ORDER BY epoch_us(ts)
        RANGE BETWEEN {span} PRECEDING AND CURRENT ROW))::BIGINT AS "trailing" FROM p)
"""


@query("trailing_60s", TRAILING_SQL.format(client="event_type", span=59_999_999) + """
SELECT client, epoch_us(ts) AS us, requests, "trailing" FROM t""")
def trailing_60s(spark, sf):
    out = LG.trailing_requests(table(spark, sf, "events"), "ts", "event_type", 60)
    return out.select("client", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "requests", "trailing")


@query("rate_report", TRAILING_SQL.format(client="'all'", span=3_599_999_999) + """
SELECT client, sum(requests)::BIGINT AS requests, max("trailing") AS peak,
  coalesce(sum(requests) FILTER (WHERE "trailing" > 13), 0)::BIGINT AS over_limit FROM t GROUP BY 1""")
def rate_report(spark, sf):
    # One client makes every request: its time line is cut into chunks, not kept in one task.
    events = table(spark, sf, "events").withColumn("client", F.lit("all"))
    return LG.rate_report(LG.trailing_requests(events, "ts", "client", 3600, 7200), 13)
