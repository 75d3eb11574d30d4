"""De-duplication, compaction, storage round trips, incremental loads and streams.

Every folder is new for each run and lies below the session's shared work folder.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from .. import schemas as SC
from ..functions.dates import month_key, parse_date, partition_columns
from ..operators import dedup as D
from ..operators import enrich as EN
from ..operators import planning as PL
from ..plans import compaction as C
from ..session import work_path
from ..sources import dataset as DS
from ..sources import json_store as J
from ..sources import lexicons as LX
from .nesting import order_span
from .registry import day_text, query, table
from .texts import HYBRID_SQL, KEY_SQL

RUN_TS = "2024-02-05 06:00:00"


def run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


def event_days(spark, sf):
    return table(spark, sf, "events").withColumn("event_day", F.col("ts").cast("date"))


# --- de-duplication, unions, differences ------------------------------------------------------

@query("dedup_keep_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_keep_last(spark, sf):
    items = table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return D.dedup_keep_last(items, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("dedup_available_keys", """
SELECT l_returnflag, l_linestatus, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2""")
def dedup_available_keys(spark, sf):
    # Two of three candidate keys exist; each holds about a third of all rows.
    items = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return D.dedup_keep_last(
        items, ["l_returnflag", "l_linestatus", "sequencial"], ["l_extendedprice"], require_all=False)


@query("union_schema", """
SELECT 'supplier' AS kind, s_suppkey AS id, s_name AS name, s_nationkey::BIGINT AS nation, NULL AS segment FROM supplier
UNION ALL SELECT 'customer', c_custkey, c_name, NULL, c_mktsegment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey::BIGINT, NULL FROM supplier""")
def union_schema(spark, sf):
    supplier = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("nation"))
    customer = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"))
    return D.union_all([supplier, customer, supplier])


@query("upsert_log", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS date, n AS records, 'old' AS run FROM o WHERE d NOT IN (SELECT d FROM e)
UNION ALL SELECT strftime(d, '%Y-%m-%d'), n, 'new' FROM e""")
def upsert_log(spark, sf):
    def entries(name, day, run):
        return table(spark, sf, name).groupBy(F.date_format(day, "yyyy-MM-dd").alias("date")).agg(
            F.count("*").alias("records"), F.lit(run).alias("run"))
    return D.upsert_by_key(entries("orders", "o_orderdate", "old"), entries("lineitem", "l_shipdate", "new"), ["date"])


@query("run_state", """
WITH l AS (SELECT d, n FROM (SELECT unnest(range(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) + INTERVAL 31 DAY, INTERVAL 1 DAY))::DATE AS d FROM orders)
           LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) USING (d))
SELECT strftime(max(d) FILTER (WHERE n > 0), '%Y-%m-%d') AS last_extraction_date, sum(n)::BIGINT AS total_records_extracted,
  count(*) AS processed_dates, count(*) FILTER (WHERE n IS NULL) AS empty_dates FROM l""")
def run_state(spark, sf):
    from ..plans.daily_load import run_state as state

    counts = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("*").alias("records"))
    first, last = order_span(spark, sf)
    planned = PL.plan_dates(spark, first and (first, last + timedelta(30)))
    log = planned.join(counts, "date", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    return state(log).withColumn("last_extraction_date", F.date_format("last_extraction_date", "yyyy-MM-dd"))


@query("last_processed", """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders ORDER BY date DESC LIMIT 3""")
def last_processed(spark, sf):
    days = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).distinct()
    return days.orderBy(F.desc("date")).limit(3)


@query("plan_dates", """
SELECT strftime(d, '%Y-%m-%d') AS date FROM (
  SELECT unnest(range(max(CAST(o_orderdate AS DATE)) + INTERVAL 1 DAY, max(CAST(o_orderdate AS DATE)) + INTERVAL 91 DAY, INTERVAL 1 DAY)) AS d FROM orders)""")
def plan_dates(spark, sf):
    """A run 90 days after the last order."""
    first, last = order_span(spark, sf)
    span = first and PL.date_span(last + timedelta(90), first, last, catch_up=True)
    return PL.plan_dates(spark, span).select(F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("date_keys", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_key, year(o_orderdate)::BIGINT AS year,
  month(o_orderdate)::BIGINT AS month, day(o_orderdate)::BIGINT AS day,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""")
def date_keys(spark, sf):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("31/31/2000"))
    return table(spark, sf, "orders").select(
        "o_orderkey", month_key("o_orderdate").alias("month_key"),
        *[c.cast("bigint").alias(n) for n, c in partition_columns("o_orderdate").items()],
        F.date_format(parse_date(text), "yyyy-MM-dd").alias("parsed"))


@query("file_dates", """
SELECT strftime(d, '%Y-%m-%d') AS file_date, d + INTERVAL 30 DAYS < TIMESTAMP '2001-06-15 06:00:00' AS old, count(*) AS files FROM (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE)
              WHEN 1 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS d FROM orders)
WHERE d IS NOT NULL GROUP BY 1, 2""")
def file_dates(spark, sf):
    from ..functions.dates import is_older_than

    name = F.when(
        F.col("o_orderkey") % 3 == 0, F.concat(F.lit("contratos_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".parquet"))
    ).when(
        F.col("o_orderkey") % 3 == 1,
        F.concat(F.lit("contratos_"), F.date_format("o_orderdate", "yyyyMM"), F.lit("_consolidated.parquet"))
    ).otherwise(F.lit("contratos_20001399.parquet"))
    dated = table(spark, sf, "orders").select(DS.date_of_name(name).alias("d")).where(F.col("d").isNotNull())
    old = is_older_than("d", F.lit("2001-06-15 06:00:00").cast("timestamp_ntz"), 30)
    return dated.groupBy(F.date_format("d", "yyyy-MM-dd").alias("file_date"), old.alias("old")).agg(
        F.count("*").alias("files"))


# --- compaction and history as plans ------------------------------------------------------------
COMPACT_RUN = "1999-07-15 12:00:00"
KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["l_partkey", "l_suppkey", "l_extendedprice"]


def daily_items(spark, sf):
    items = table(spark, sf, "lineitem")
    return items.withColumns(partition_columns("l_shipdate"))


def monthly_items(spark, sf):
    """The months' earlier state: every row once more, with a price of its own."""
    items = table(spark, sf, "lineitem").withColumn("l_extendedprice", -F.col("l_extendedprice"))
    parts = partition_columns("l_shipdate")
    return items.withColumns({"year": parts["year"], "month": parts["month"]})


COMPACT_SQL = f"""
WITH d AS (SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, CAST(l_shipdate AS DATE) AS fd, 1 AS src,
             l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem),
old AS (SELECT * FROM d WHERE fd + INTERVAL 30 DAYS < TIMESTAMP '{COMPACT_RUN}'),
mo AS (SELECT y, m, make_date(y, m, 1) AS fd, 0 AS src, l_orderkey, l_linenumber, l_partkey, l_suppkey, -l_extendedprice AS l_extendedprice
       FROM d WHERE (y, m) IN (SELECT (y, m) FROM old)),
u AS (SELECT * FROM old UNION ALL SELECT * FROM mo)
"""


@query("compact_month", COMPACT_SQL + """
SELECT y::BIGINT AS year, m::BIGINT AS month, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY y, m, l_orderkey, l_linenumber
    ORDER BY src DESC, fd DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM u) WHERE rn = 1""")
def compact_month(spark, sf):
    run = F.lit(COMPACT_RUN).cast("timestamp_ntz")
    out = C.compacted(daily_items(spark, sf), monthly_items(spark, sf), run, 30, KEYS, ORDER)
    return out.select(
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), *KEYS, "l_extendedprice")


@query("months_to_compact", COMPACT_SQL + "SELECT y::BIGINT AS year, m::BIGINT AS month, count(DISTINCT fd) AS days FROM old GROUP BY 1, 2")
def months_to_compact(spark, sf):
    days = C.with_partition_date(daily_items(spark, sf).select("year", "month", "day"))
    out = C.months_with_old_days(days, F.lit(COMPACT_RUN).cast("timestamp_ntz"), 30)
    return out.select(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), "days")


@query("history", """
SELECT l_orderkey, l_linenumber, l_extendedprice, '1999-07-15T12:00:00.000000' AS consolidation_date FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY src DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM (SELECT 0 AS src, l_orderkey, l_linenumber, l_partkey, l_suppkey, -l_extendedprice AS l_extendedprice FROM lineitem
        UNION ALL SELECT 1, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_returnflag <> 'R'))
WHERE rn = 1""")
def history(spark, sf):
    newer = daily_items(spark, sf).where("l_returnflag <> 'R'")
    out = C.history([monthly_items(spark, sf), newer], F.lit(COMPACT_RUN).cast("timestamp_ntz"), KEYS, ORDER)
    return out.select(*KEYS, "l_extendedprice", "consolidation_date")


# --- storage round trips ---------------------------------------------------------------------------

@query("daily_round_trip", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS data_publicacao, '2024-02-05T06:00:00.000000' AS extraction_date,
  CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN -value ELSE value END AS value,
  2024::BIGINT AS year, 1::BIGINT AS month FROM events WHERE year(ts) = 2024 AND month(ts) = 1""")
def daily_round_trip(spark, sf):
    path = work_path(spark, "daily")
    events = DS.with_control_columns(event_days(spark, sf), run_ts(), "event_day")
    DS.write_daily(events, path, "event_day")
    again = events.where(F.col("event_day") == F.lit("2024-01-05").cast("date")).withColumn("value", -F.col("value"))
    DS.write_daily(again, path, "event_day")
    DS.write_daily(events.where("false"), path, "event_day")
    stored = DS.read_dataset(spark, path).where("year = 2024 AND month = 1")
    return stored.select("event_id", "data_publicacao", "extraction_date", "value",
                         F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query("source_file_count", "SELECT count(*) AS total_records FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-03'")
def source_file_count(spark, sf):
    path = work_path(spark, "daily")
    DS.write_daily(event_days(spark, sf), path, "event_day")
    return DS.count_from_file(DS.read_dataset(spark, path).where("year = 2024 AND month = 1"), "day=3/")


@query("named_files", """
SELECT event_type, strftime(CASE event_type WHEN 'view' THEN DATE '2024-01-02' WHEN 'purchase' THEN DATE '2024-01-05'
    WHEN 'error' THEN DATE '2024-03-01' ELSE DATE '2024-02-01' END, '%Y-%m-%d') AS file_date,
  count(*) AS events FROM events WHERE event_type <> 'click' GROUP BY 1, 2""")
def named_files(spark, sf):
    root = work_path(spark, "named")
    # The file of clicks has no date in its name and is left out, which is what is shown here.
    names = {"view": "contratos_20240102.parquet", "purchase": "contratos_20240105.parquet", "signup": "contratos_202402_consolidated.parquet",
             "error": "contratos_202403_consolidated.parquet", "click": "contratos_x.parquet"}
    for kind, name in names.items():
        table(spark, sf, "events").where(F.col("event_type") == kind).write.parquet(f"{root}/{name}")
    files = spark.read.parquet(*[f"{root}/{n}" for n in names.values()])
    return DS.with_file_date(files).groupBy("event_type", F.date_format("file_date", "yyyy-MM-dd").alias("file_date")).agg(
        F.count("*").alias("events"))


# Orders as contracts of 60 days; some are published again on the next day, at another value. Two orders may share all keys of a month.
CONTRACT_SQL = """
WITH o AS (SELECT o_orderkey, DATE '2024-01-01' + (o_orderkey % 60)::INT AS d, 'U' || o_custkey % 50 AS unit, o_orderpriority AS what,
             round(o_totalprice * 100)::BIGINT AS cents FROM orders),
days AS (SELECT o_orderkey // 3 AS seq, unit, strftime(d, '%Y-%m-%d') AS published, what, cents, d FROM o
  UNION ALL SELECT o_orderkey // 3, unit, strftime(d, '%Y-%m-%d'), what, cents + 100, d + INTERVAL 1 DAY FROM o WHERE o_orderkey % 5 = 0),
before AS (SELECT o_orderkey // 3 AS seq, unit, strftime(d, '%Y-%m-%d') AS published, what, -1 AS cents, date_trunc('month', d) AS d FROM o WHERE o_orderkey % 7 = 0),
late AS (SELECT o_orderkey // 3 AS seq, unit, strftime(d, '%Y-%m-%d') AS published, what, cents + 200 AS cents, DATE '2024-01-03' AS d FROM o WHERE o_orderkey % 60 = 2 AND o_orderkey % 4 = 0)
"""


def contract_days(spark, sf):
    """Contracts by the day folder they land in, those of an earlier month state, and some that land late."""
    o = table(spark, sf, "orders")
    day = F.expr("date_add(DATE '2024-01-01', CAST(o_orderkey % 60 AS INT))")
    amount = F.round(F.col("o_totalprice") * 100).cast("bigint")

    def rows(df, cents, landed):
        return df.select(
            F.expr("o_orderkey div 3").alias("sequencialContratacao"), F.concat(F.lit("U"), F.col("o_custkey") % 50).alias("codigoUnidadeOrgao"),
            F.date_format(day, "yyyy-MM-dd").alias("dataPublicacao"), F.col("o_orderpriority").alias("objetoContrato"),
            (cents.cast("decimal(18,2)") / 100).cast("double").alias("valorContrato"), landed.alias("landed"))

    days = rows(o, amount, day).unionByName(rows(o.where("o_orderkey % 5 = 0"), amount + 100, F.date_add(day, 1)))
    before = rows(o.where("o_orderkey % 7 = 0"), F.lit(-1), F.trunc(day, "month"))
    late = rows(o.where("o_orderkey % 60 = 2 AND o_orderkey % 4 = 0"), amount + 200, F.lit("2024-01-03").cast("date"))
    return days, before, late


VALUE_ORDER = ["valorContrato"]
PLACES = """
SELECT place, count(*) AS contracts, count(DISTINCT (seq, unit, published, what)) AS contract_keys, sum(cents)::BIGINT AS cents FROM """


@query("compact_store", CONTRACT_SQL + """,
old AS (SELECT *, 1 AS rank FROM days WHERE d + INTERVAL 20 DAYS < TIMESTAMP '2024-02-05 06:00:00'
  UNION ALL SELECT *, 0 FROM before WHERE d = DATE '2024-01-01'),
first AS (SELECT * EXCLUDE (rn) REPLACE (0 AS rank, DATE '2024-01-01' AS d) FROM (
  SELECT *, row_number() OVER (PARTITION BY seq, unit, published, what ORDER BY rank DESC, d DESC, cents DESC) AS rn FROM old) WHERE rn = 1),
merged AS (SELECT * FROM first UNION ALL SELECT *, 1 FROM late),
second AS (SELECT *, row_number() OVER (PARTITION BY seq, unit, published, what ORDER BY rank DESC, d DESC, cents DESC) AS rn FROM merged)""" + PLACES + """(
  SELECT 'monthly' AS place, seq, unit, published, what, cents FROM second WHERE rn = 1
  UNION ALL SELECT 'monthly', seq, unit, published, what, cents FROM before WHERE d > DATE '2024-01-01'
  UNION ALL SELECT 'daily', seq, unit, published, what, cents FROM days WHERE d + INTERVAL 20 DAYS >= TIMESTAMP '2024-02-05 06:00:00') GROUP BY 1""")
def compact_store(spark, sf):
    """Two compactions with the default keys; between them a file lands in a day that is compacted already."""
    store = work_path(spark, "store")
    days, before, late = contract_days(spark, sf)
    DS.write_monthly(before, f"{store}/consolidated", "landed")
    DS.write_daily(days, f"{store}/raw-data", "landed")
    C.compact_months(spark, store, run_ts(), 20, order=VALUE_ORDER)
    DS.write_daily(late, f"{store}/raw-data", "landed")
    C.compact_months(spark, store, run_ts(), 20, order=VALUE_ORDER)

    def place(name, folder):
        return DS.read_dataset(spark, f"{store}/{folder}").select(F.lit(name).alias("place"), *V_KEYS, "valorContrato")

    return place("monthly", "consolidated").unionByName(place("daily", "raw-data")).groupBy("place").agg(
        F.count("*").alias("contracts"), F.countDistinct(*V_KEYS).alias("contract_keys"),
        F.sum(F.round(F.col("valorContrato") * 100).cast("bigint")).alias("cents"))


V_KEYS = [k for k in V.MONTH_DEDUP_KEYS if k != "numeroContratacao"]  # the contract table has no such column


@query("history_store", CONTRACT_SQL + """,
u AS (SELECT *, 0 AS rank FROM before UNION ALL SELECT *, 1 FROM days UNION ALL SELECT * REPLACE (DATE '2024-03-20' AS d), 1 FROM late)
SELECT seq, unit, published, what, cents, '2024-03-21T06:00:00.000000' AS consolidation_date FROM (
  SELECT *, row_number() OVER (PARTITION BY seq, unit, published ORDER BY rank DESC, d DESC, cents DESC, what DESC) AS rn FROM u) WHERE rn = 1""")
def history_store(spark, sf):
    """Two versions with the default keys; the second makes again only the months that late rows of a later day belong to."""
    store = work_path(spark, "store")
    days, before, late = contract_days(spark, sf)
    order = ["valorContrato", "objetoContrato"]
    DS.write_daily(days, f"{store}/raw-data", "landed")
    DS.write_monthly(before, f"{store}/consolidated", "landed")
    C.rebuild_history(spark, store, run_ts(), order=order)
    DS.write_daily(late.withColumn("landed", F.lit("2024-03-20").cast("date")), f"{store}/raw-data", "landed")
    C.rebuild_history(spark, store, F.lit("2024-03-21 06:00:00").cast("timestamp_ntz"), order=order)
    return C.read_history(spark, store).select(
        F.col("sequencialContratacao").alias("seq"), F.col("codigoUnidadeOrgao").alias("unit"), F.col("dataPublicacao").alias("published"),
        F.col("objetoContrato").alias("what"), F.round(F.col("valorContrato") * 100).cast("bigint").alias("cents"), "consolidation_date")


@query("json_round_trip", "SELECT item_id, text FROM benchmark")
def json_round_trip(spark, sf):
    path = work_path(spark, "json")
    if J.load_json(spark, path, "item_id bigint, text string") is not None:
        raise RuntimeError("a missing dataset must read as None")
    J.write_json(table(spark, sf, "benchmark"), path)
    return J.load_json(spark, path, "item_id bigint, text string")


@query("json_upsert", """
SELECT lang, count(*) AS docs, CASE WHEN lang IN ('fr', 'de') THEN 'second' ELSE 'first' END AS run FROM documents GROUP BY 1""")
def json_upsert(spark, sf):
    path = work_path(spark, "log")
    counts = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("docs"))
    J.upsert_json(counts.withColumn("run", F.lit("first")), path, ["lang"])
    J.upsert_json(counts.where("lang in ('fr', 'de')").withColumn("run", F.lit("second")), path, ["lang"])
    return J.load_json(spark, path, "docs bigint, run string").select("lang", "docs", "run")


@query("lexicon_files", """
SELECT 'pairs' AS source, p_type AS "group", p_name AS term FROM part
UNION ALL SELECT DISTINCT 'map', p_type, lower(p_name) FROM part""")
def lexicon_files(spark, sf):
    from ..operators.lexicon import build_lexicon

    part = table(spark, sf, "part")
    csv, text = work_path(spark, "pairs"), work_path(spark, "map")
    part.select(F.col("p_type").alias("grupo"), F.col("p_name").alias("sub")).write.csv(csv, sep=";", header=True)
    pairs = LX.read_pairs(spark, csv).select(F.lit("pairs").alias("source"), "group", "term")
    # One JSON object per group: an object of all groups would be one row.
    built = build_lexicon(part, "p_type", "p_name")
    built.select(F.to_json(F.create_map("group", "terms")).alias("value")).repartition("value").write.text(text)
    lines = spark.read.text(text).select(F.from_json("value", LX.LEXICON_MAP).alias("m"))
    terms = LX.explode_map(lines, "m").select(F.lit("map").alias("source"), "group", F.explode("terms").alias("term"))
    return pairs.unionByName(terms)


@query("lexicon_map_file", """
WITH g AS (SELECT p_brand AS "group", array_agg(DISTINCT p_type ORDER BY p_type) AS terms FROM part WHERE p_brand IS NOT NULL GROUP BY 1)
SELECT "group", row_number() OVER (ORDER BY "group") - 1 AS group_pos, unnest(terms) AS term FROM g""")
def lexicon_map_file(spark, sf):
    """One JSON object of all brands with their types, written as a file and read back in the order of its keys."""
    path = work_path(spark, "map")
    part = table(spark, sf, "part").where(F.col("p_brand").isNotNull() & F.col("p_type").isNotNull())
    groups = part.groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("terms"))
    whole = F.map_from_entries(F.array_sort(F.collect_list(F.struct("p_brand", "terms"))))
    groups.agg(F.to_json(whole).alias("value")).write.text(path)
    return LX.read_map(spark, path).select("group", "group_pos", F.explode("terms").alias("term"))


def through_table(spark, name, result):
    """The result of a query on a catalog table, stored, so that the table's name can go from the catalog."""
    path = work_path(spark, "result")
    try:
        result().write.parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(path)


def monthly_events(spark, sf, path):
    """Events stored by month; returns the schema of a table over them."""
    events = event_days(spark, sf)
    DS.write_monthly(events, path, "event_day")
    return T.StructType([*events.schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])


@query("external_table", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS records, round(avg(value::DECIMAL(18, 6)), 2) AS mean_amount
FROM events WHERE year(ts) = 2024 AND month(ts) = 1 GROUP BY 1""")
def external_table(spark, sf):
    path, name = work_path(spark, "table"), f"events_{uuid.uuid4().hex[:8]}"
    DS.create_external_table(spark, name, path, monthly_events(spark, sf, path))
    return through_table(spark, name, lambda: spark.sql(f"""
        SELECT date_format(event_day, 'yyyy-MM-dd') AS day, count(*) AS records, CAST(round(avg(CAST(value AS DECIMAL(18, 6))), 2) AS DOUBLE) AS mean_amount
        FROM {name} WHERE year = 2024 AND month = 1 GROUP BY event_day"""))


@query("projected_table", """
SELECT year(ts)::BIGINT AS year, month(ts)::BIGINT AS month, event_type, count(*) AS records FROM events GROUP BY ALL""")
def projected_table(spark, sf):
    """Partitions declared from the first month of the table to its last; the rows moved past it are in no partition."""
    path, name = work_path(spark, "projected"), f"events_{uuid.uuid4().hex[:8]}"
    schema = monthly_events(spark, sf, path)
    events = event_days(spark, sf)
    DS.write_monthly(events.withColumn("event_day", F.add_months("event_day", 240)), path, "event_day")
    first, last = events.agg(F.min("event_day"), F.max("event_day")).first()
    if first is not None:
        DS.create_projected_table(spark, name, path, schema, first, last)
    else:
        DS.create_external_table(spark, name, path, schema)
    return through_table(spark, name, lambda: spark.table(name).groupBy(
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"), "event_type").agg(
        F.count("*").alias("records")))


@query("skipped_files", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS records,
  CASE WHEN bool_or(event_type = 'error') THEN 'no footer at the end of the file' END AS skipped
FROM events GROUP BY 1""")
def skipped_files(spark, sf):
    """Days of events; those with an error have files among their own that are no Parquet, which are left out and listed."""
    path = work_path(spark, "damaged")
    events = event_days(spark, sf)
    DS.write_daily(events, path, "event_day")
    errors = events.where("event_type = 'error'").withColumns(partition_columns("event_day"))
    errors.select(*DS.DAY_PARTITIONS, F.concat(F.lit("error of event "), F.col("event_id")).alias("value")).write.mode(
        "append").partitionBy(*DS.DAY_PARTITIONS).text(path)
    kept, skipped = DS.read_sound_files(spark, path)
    day = F.make_date(*[DS.folder_value(F.col("path"), p) for p in DS.DAY_PARTITIONS])
    bad = skipped.groupBy(day.alias("event_day")).agg(F.min("error").alias("skipped"))
    return kept.groupBy("event_day").agg(F.count("*").alias("records")).join(bad, "event_day", "left").select(
        day_text("event_day").alias("day"), "records", "skipped")


@query("normalised_table", """
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS amount, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS cnpj, true AS whole FROM customer""")
def normalised_table(spark, sf):
    from .. import schemas as S
    from ..functions.nested import fill_struct
    from .nesting import agencies

    name = f"customers_{uuid.uuid4().hex[:8]}"
    rows = fill_struct(agencies(spark, sf), "orgaoEntidade", S.AGENCY).select(
        "c_custkey", F.col("c_nationkey").cast("double").alias("amount"), "orgaoEntidade")
    DS.create_table_as(rows, name, work_path(spark, "ctas"))
    return through_table(spark, name, lambda: spark.table(name).select(
        "c_custkey", "amount", F.col("orgaoEntidade.cnpj").alias("cnpj"), F.col("orgaoEntidade").isNotNull().alias("whole")))


@query("rewrite_to_schema", """
SELECT c_custkey, c_name, NULL::VARCHAR AS cnpj, 'rewritten' AS place FROM customer
UNION ALL SELECT c_custkey, c_name, NULL, 'backup' FROM customer""")
def rewrite_to_schema(spark, sf):
    from .. import schemas as S

    path, backup = work_path(spark, "bad"), work_path(spark, "backup")
    # The nested field was written as text, as happens when a day has no value for it.
    table(spark, sf, "customer").select("c_custkey", "c_name", F.lit(None).cast("string").alias("orgaoEntidade")).write.parquet(path)
    want = T.StructType([
        T.StructField("c_name", T.StringType()), T.StructField("orgaoEntidade", S.AGENCY), T.StructField("c_custkey", T.LongType())])
    DS.rewrite_to_schema(spark, path, want, backup)
    new = spark.read.parquet(path).select("c_custkey", "c_name", F.col("orgaoEntidade.cnpj").alias("cnpj"), F.lit("rewritten").alias("place"))
    old = spark.read.parquet(backup).select("c_custkey", "c_name", F.col("orgaoEntidade").alias("cnpj"), F.lit("backup").alias("place"))
    return new.unionByName(old)


# --- incremental load and streams ---------------------------------------------------------------------

# Documents as notices: published on one of 36 days, landed as pages of JSON envelopes.
NOTICE_DAY = "date_add(DATE '2024-01-01', CAST(doc_id % 36 AS INT))"
NOTICE_ROWS = T.StructType([f for f in SC.NOTICE.fields if f.name in ("numeroCompra", "objetoCompra", "modalidadeId", "orgaoEntidade")])


def land_notices(spark, sf, path, page_size=50):
    """Writes the envelopes, a JSON line each, into a folder per date; a page holds at most ``page_size`` notices."""
    agency = F.struct(F.col("source").alias("cnpj"), F.upper(F.substring("lang", 1, 1)).alias("esferaId"))
    notice = F.struct(
        F.col("doc_id").cast("string").alias("numeroCompra"), F.col("text").alias("objetoCompra"), (F.col("doc_id") % 15).alias("modalidadeId"),
        F.when(F.col("doc_id") % 4 != 0, agency).alias("orgaoEntidade"))
    rows = table(spark, sf, "documents").select(
        F.expr(NOTICE_DAY).alias("date"), F.expr(f"doc_id div {36 * page_size}").alias("page"), notice.alias("notice"))
    pages = rows.groupBy("date", "page").agg(F.collect_list("notice").alias("data"), F.count("*").alias("totalRegistros"))
    envelope = F.struct("data", F.lit(1).alias("totalPaginas"), "totalRegistros")
    pages.select("date", F.to_json(envelope).alias("value")).write.partitionBy("date").text(path)


def notice_domains(spark, sf):
    nation = EN.domain_table(table(spark, sf, "nation").where("n_nationkey < 12"), "n_nationkey", "n_name")
    return {"modalidade": nation}


def called_verdicts(spark, sf):
    """Stored verdicts with the figures of their model calls."""
    from .texts import verdict_table

    return verdict_table(spark, sf).withColumns({
        "tokens_used": F.col("cache_id"), "response_time": F.col("cache_id") / 8, "cached": F.col("cache_id") % 2 == 0})


def load_notices(spark, sf, store, landing, runs):
    """Envelopes through the record pipeline into day folders, with a log row a date; one run for each (time, catch-up)."""
    from ..plans.daily_load import run_daily_load
    from ..plans.hybrid import hybrid_filter
    from ..plans.records import finish_records
    from ..sources import envelopes as EV
    from .texts import lexicon_frame

    for run, catch_up in runs:
        records = EV.explode_envelopes(EV.read_envelopes(spark, landing, NOTICE_ROWS))
        run_daily_load(
            spark, store, records, "date", lambda kept: finish_records(kept, notice_domains(spark, sf)), run, date(2024, 1, 1), catch_up=catch_up,
            judge=lambda df: hybrid_filter(df, "objetoCompra", lexicon_frame(spark), called_verdicts(spark, sf), on_missing="keep", id_col="numeroCompra"))


LOAD_RUNS = ((datetime(2024, 1, 10, 6), False), (datetime(2024, 2, 5, 6), True), (datetime(2024, 2, 5, 6), True))
LOADED_SQL = HYBRID_SQL + """,
n AS (SELECT DATE '2024-01-01' + (doc_id % 36)::INT AS d, h.*, cache_id FROM h LEFT JOIN repaired r ON has_verdict AND r.key = """ + KEY_SQL.format("h.text") + """),
days AS (SELECT unnest(range(DATE '2024-01-01', DATE '2024-02-06', INTERVAL 1 DAY))::DATE AS d),
c AS (SELECT d, count(*) AS total, count(grp) AS first, count(*) FILTER (has_verdict) AS second,
  count(*) FILTER (has_verdict AND decisao = 'APROVAR') AS second_yes, count(*) FILTER (included) AS kept,
  count(*) FILTER (grp IS NULL AND text <> '') AS saved, count(*) FILTER (cache_id % 2 = 0) AS hits,
  coalesce(sum(cache_id), 0)::BIGINT AS tokens FROM n GROUP BY d),
g AS (SELECT d, grp, count(*) AS k FROM n WHERE grp IS NOT NULL GROUP BY ALL),
gt AS (SELECT d, string_agg(grp || '=' || k, ';' ORDER BY k DESC, grp) AS groups FROM (
  SELECT *, row_number() OVER (PARTITION BY d ORDER BY k DESC, grp) AS rn FROM g) WHERE rn <= 10 GROUP BY d),
t AS (SELECT d, term, count(*) AS k FROM n WHERE term IS NOT NULL GROUP BY ALL),
tt AS (SELECT d, string_agg(term || '=' || k, ';' ORDER BY k DESC, term) AS terms FROM (
  SELECT *, row_number() OVER (PARTITION BY d ORDER BY k DESC, term) AS rn FROM t) WHERE rn <= 10 GROUP BY d)
"""
DAILY_LOAD_SQL = LOADED_SQL + """
SELECT strftime(d, '%Y-%m-%d') AS date, coalesce(kept, 0) AS records,
  CASE WHEN d <= DATE '2024-01-10' THEN '2024-01-10T06:00:00' ELSE '2024-02-05T06:00:00' END AS timestamp,
  total AS total_analisados, first AS etapa1_aprovados, total - first AS etapa1_rejeitados, second_yes AS etapa2_aprovados,
  second - second_yes AS etapa2_rejeitados, kept AS filtrados_aprovados, total - kept AS filtrados_rejeitados, saved AS llm_economizados,
  round(100 * kept / total, 2) AS taxa_aprovacao_final_percent, round(100 * first / total, 2) AS taxa_etapa1_aprovacao_percent,
  round(100 * saved / total, 2) AS taxa_economia_llm_percent, second > 0 AS filtro_hibrido_ativo,
  CASE WHEN total > 0 THEN coalesce(groups, '') END AS top_grupos, CASE WHEN total > 0 THEN coalesce(terms, '') END AS top_termos,
  second AS verdicts, hits AS cache_hits, tokens AS total_tokens
FROM days LEFT JOIN c USING (d) LEFT JOIN gt USING (d) LEFT JOIN tt USING (d)"""


def load_log(spark, store):
    from ..plans.daily_load import COUNTS, LOG_SCHEMA, RATES

    named = lambda c: F.array_join(F.transform(f"filter_stats.{c}", lambda x: F.concat_ws("=", x["name"], x["matches"])), ";").alias(c)
    return J.load_json(spark, f"{store}/metadata/extraction_log", LOG_SCHEMA).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "records", "timestamp", *[f"filter_stats.{c}" for c in (*COUNTS, *RATES)],
        "filter_stats.filtro_hibrido_ativo", named("top_grupos"), named("top_termos"), "filter_stats.llm_stats.*")


@query("daily_load", DAILY_LOAD_SQL)
def daily_load(spark, sf):
    store, landing = work_path(spark, "store"), work_path(spark, "landing")
    land_notices(spark, sf, landing)
    load_notices(spark, sf, store, landing, LOAD_RUNS)
    return load_log(spark, store)


@query("daily_load_rerun", HYBRID_SQL + """
SELECT doc_id, strftime(DATE '2024-01-01' + (doc_id % 36)::INT, '%Y-%m-%d') AS data_publicacao, '2024-02-05T06:00:00.000000' AS extraction_date,
  reason, coalesce(n_name, 'Modalidade ' || (doc_id % 15)) AS modality_name
FROM h LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON n_nationkey = doc_id % 15 WHERE included""")
def daily_load_rerun(spark, sf):
    """Data of a run that was lost before its log was written is replaced, not doubled, by the next one."""
    store, landing = work_path(spark, "store"), work_path(spark, "landing")
    land_notices(spark, sf, landing)
    load_notices(spark, sf, store, landing, [(datetime(2024, 2, 4, 6), False)])
    DS.delete_path(spark, f"{store}/metadata/extraction_log")
    load_notices(spark, sf, store, landing, [(datetime(2024, 2, 5, 6), False)])
    return DS.read_dataset(spark, f"{store}/raw-data", all_columns=True).select(
        F.col("numeroCompra").cast("bigint").alias("doc_id"), "data_publicacao", "extraction_date",
        F.col(V.FILTER_COLUMNS["reason"]).alias("reason"), F.col("modalidade_nome_dominio").alias("modality_name"))


@query("hybrid_details", HYBRID_SQL + f"""
SELECT doc_id, cache_id AS tokens_used, cache_id / 8 AS response_time, cache_id % 2 = 0 AS cached,
  CASE WHEN grp IS NOT NULL AND NOT has_verdict THEN true END AS available
FROM h LEFT JOIN repaired r ON has_verdict AND r.key = {KEY_SQL.format('h.text')}""")
def hybrid_details(spark, sf):
    from ..plans.hybrid import hybrid_filter
    from .texts import lexicon_frame

    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = hybrid_filter(docs, "text", lexicon_frame(spark), called_verdicts(spark, sf), on_missing="keep", id_col="doc_id")
    names = {"llm_tokens_used": "tokens_used", "llm_response_time": "response_time", "llm_cached": "cached", "llm_disponivel": "available"}
    return out.select("doc_id", *[F.col(f"details.{k}").alias(v) for k, v in names.items()])


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _run_to_table(spark, stream, mode):
    """Runs a stream over all present files into one folder per batch and reads the last state back."""
    path, checkpoint = work_path(spark, "stream"), work_path(spark, "stream-checkpoint")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:06d}")

    q = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    out = spark.read.parquet(path)
    return out.where(F.col("batch") == out.agg(F.max("batch")).first()[0]).drop("batch")


def _log_sql():
    from .logging import USAGE_SQL

    return USAGE_SQL.format(width="5 MINUTES")


@query("stream_log_5m", _log_sql())
def stream_log_5m(spark, sf):
    from ..streaming.log_bins import usage_bins
    from .logging import MESSAGE
    from .registry import time_text

    lines = event_stream(spark, sf).withColumn("message", F.expr(MESSAGE.replace("VARCHAR(20)", "STRING")))
    return _run_to_table(spark, usage_bins(lines, "ts", "message"), "complete").withColumn("bin", time_text("bin"))


@query("stream_alerts", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS bin, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS value
FROM events GROUP BY 1 HAVING sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 4""")
def stream_alerts(spark, sf):
    from ..streaming.log_bins import alert_bins
    from .registry import time_text

    errors = (F.col("event_type") == "error").cast("bigint")
    alerts = alert_bins(event_stream(spark, sf), "ts", errors, "1 hour", ">", 4)
    return _run_to_table(spark, alerts, "complete").withColumn("bin", time_text("bin"))


@query("stream_incremental", """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS events, round(sum(value), 2) AS value
FROM events WHERE event_type <> 'error' GROUP BY 1, 2""")
def stream_incremental(spark, sf):
    from ..streaming.incremental import load_new_files

    target, checkpoint = work_path(spark, "loaded"), work_path(spark, "loaded-checkpoint")

    def keep(df):
        return df.where("event_type <> 'error'").withColumn("event_day", F.col("ts").cast("date"))

    for _ in range(2):  # the second run finds no new file
        load_new_files(event_stream(spark, sf), keep, "event_day", target, checkpoint)
    return DS.read_dataset(spark, target).groupBy(F.date_format("event_day", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("value"))


def append_source(spark, sf, path):
    """Events as four files: half of the time, the rest, rows of the first days once more, and a row a day after the last.

    What is late is told by the watermark of the batch before, so the late rows have a batch of their own.
    """
    events = event_days(spark, sf).drop("event_day")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(first + (last - first) / 2)
    late = events.where(F.col("ts") < F.lit(first + (last - first) / 10))
    closing = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(last + timedelta(days=1)).alias("ts"), F.lit(0).cast("bigint").alias("user_id"),
        F.lit("closing").alias("event_type"), F.lit(0.0).alias("value"))
    schema = events.schema
    for part in (events.where(F.col("ts") <= middle), events.where(F.col("ts") > middle), late, closing):
        part.select(*[F.col(f.name).cast(f.dataType) for f in schema if f.name in part.columns]).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_append(spark, stream):
    """Runs a stream in append mode over all present files; returns what came out and the progress of its batches."""
    path = work_path(spark, "appended")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:06d}")

    q = (stream.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", work_path(spark, "appended-checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(path).drop("batch"), [json.loads(p.json) if hasattr(p, "json") else p for p in q.recentProgress]


def append_alarms():
    error = F.col("event_type") == "error"
    return {"errors": (F.when(error, F.lit(1)), "sum", ">", 1), "mean_value": (F.col("value"), "avg", ">=", 20)}


@query("stream_alerts_append", """
SELECT 'errors' AS alarm, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS bin, count(*)::DOUBLE AS value
FROM events WHERE event_type = 'error' GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'mean_value', strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S'), round(sum(value::DECIMAL(28, 9))::DOUBLE / count(*), 4)
FROM events GROUP BY 2 HAVING sum(value::DECIMAL(28, 9))::DOUBLE / count(*) >= 20""")
def stream_alerts_append(spark, sf):
    """Closed bins only: a last row moves the watermark past all others, and rows that come half the time too late change nothing."""
    from ..streaming.log_bins import alarm_windows
    from .registry import time_text

    source = append_source(spark, sf, work_path(spark, "append-source"))
    out, _ = run_append(spark, alarm_windows(source, "ts", "1 hour", append_alarms()))
    return out.select("alarm", time_text("bin").alias("bin"), F.round("value", 4).alias("value"))


def stream_notices(spark, sf, target, checkpoint, ledger, landing):
    from ..plans.records import record_pipeline
    from ..sources import envelopes as EV
    from ..streaming.incremental import load_new_files
    from .texts import lexicon_frame

    pages = spark.readStream.schema(T.StructType([*EV.envelope_schema(NOTICE_ROWS).fields, T.StructField("date", T.DateType())])).json(landing)

    def keep(batch):
        records = EV.explode_envelopes(batch)
        return record_pipeline(records, "objetoCompra", lexicon_frame(spark), notice_domains(spark, sf), called_verdicts(spark, sf),
                               on_missing="keep", id_col="numeroCompra")

    load_new_files(pages, keep, "date", target, checkpoint, ledger=ledger)


@query("stream_records", HYBRID_SQL + """
SELECT doc_id, strftime(DATE '2024-01-01' + (doc_id % 36)::INT, '%Y-%m-%d') AS day, reason,
  coalesce(n_name, 'Modalidade ' || (doc_id % 15)) AS modality_name,
  (SELECT count(*) FROM h WHERE included) AS ledger_rows
FROM h LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON n_nationkey = doc_id % 15 WHERE included""")
def stream_records(spark, sf):
    """Landed envelopes through the record pipeline as they come; the second run finds none that is new."""
    from ..streaming.incremental import read_loaded, run_state

    target, checkpoint, ledger, landing = (work_path(spark, n) for n in ("records", "records-checkpoint", "records-ledger", "landing"))
    land_notices(spark, sf, landing)
    for _ in range(2):
        stream_notices(spark, sf, target, checkpoint, ledger, landing)
    return read_loaded(spark, target, ledger).select(
        F.col("numeroCompra").cast("bigint").alias("doc_id"), F.date_format("date", "yyyy-MM-dd").alias("day"),
        F.col(V.FILTER_COLUMNS["reason"]).alias("reason"), F.col("modalidade_nome_dominio").alias("modality_name"),
        run_state(spark, ledger).select("rows").scalar().alias("ledger_rows"))
