"""Reports over orders as contracts: amount, date, category (priority), status."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.text import contains_any_lower, matches_any
from ..operators import reports as R
from ..session import work_path
from .registry import query, sql_text, table


@query("monthly_count", """
SELECT count(*) AS total FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 8""")
def monthly_count(spark, sf):
    return R.row_total(R.in_month(table(spark, sf, "orders"), "o_orderdate", 1997, 8))


@query("daily_profile", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS records, ((2 * sum((o_totalprice::DECIMAL(18, 2) * 100)::BIGINT) + count(o_totalprice)) // (2 * count(o_totalprice)))::DOUBLE / 100 AS mean_amount
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""")
def daily_profile(spark, sf):
    orders = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_totalprice")
    return R.daily_profile(orders, "day", "o_totalprice")


@query("category_totals", """
SELECT o_orderpriority, count(*) AS contracts, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS amount FROM orders GROUP BY 1""")
def category_totals(spark, sf):
    return R.category_totals(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")


@query("top_contracts", """
SELECT o_orderkey, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10""")
def top_contracts(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return R.top_by_amount(orders, "o_totalprice", "o_orderkey")


@query("reason_breakdown", """
SELECT o_orderstatus = 'F' AS applied, o_orderpriority AS reason, count(*) AS quantity FROM orders GROUP BY 1, 2""")
def reason_breakdown(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderstatus") == "F").alias("applied"), F.col("o_orderpriority").alias("reason"))
    return R.reason_breakdown(orders, "applied", "reason")


@query("substring_any", """
SELECT doc_id, lang, n_chars FROM documents
WHERE lower(text) LIKE '%système%' OR lower(text) LIKE '%éçê%' OR lower(text) LIKE '%ciónes%' OR lower(text) LIKE '%thwh%'""")
def substring_any(spark, sf):
    docs = table(spark, sf, "documents")
    hit = contains_any_lower("text", ["système", "éçê", "ciónes", "thwh"])
    return docs.where(hit).select("doc_id", "lang", "n_chars").orderBy(F.desc("n_chars"), "doc_id")


@query("regex_any", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(p_name), 'small|g[ei]|anvil$')""")
def regex_any(spark, sf):
    return table(spark, sf, "part").where(matches_any("p_name", ["small", "g[ei]", "anvil$"])).select("p_partkey", "p_name")


@query("keyword_and_amount", """
WITH t AS (
  SELECT p_partkey, p_retailprice,
         contains(lower(p_name), 'widget') OR contains(lower(p_name), 'ring') OR contains(lower(p_name), 'gi') AS on_topic,
         p_retailprice >= 950 AS high_value
  FROM part)
SELECT p_partkey, on_topic, high_value, on_topic AND high_value AS approved,
       'TI: ' || CASE WHEN on_topic THEN 'True' ELSE 'False' END
       || ', Alto valor: ' || CASE WHEN high_value THEN 'True' ELSE 'False' END AS reasoning
FROM t""")
def keyword_and_amount(spark, sf):

    marked = R.batch_verdicts(
        table(spark, sf, "part"), "p_name", "p_retailprice", ["widget", "ring", "gi"], 950, V.BATCH_REASON)
    return marked.select("p_partkey", "on_topic", "high_value", "approved", "reasoning")


@query("fact_summary", """
SELECT year(o_orderdate)::BIGINT AS year, month(o_orderdate)::BIGINT AS month, o_orderpriority, o_orderstatus,
       c_mktsegment, count(o_orderkey) AS contracts, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS amount,
       ((2 * sum((o_totalprice::DECIMAL(18, 2) * 100)::BIGINT) + count(o_totalprice)) // (2 * count(o_totalprice)))::DOUBLE / 100 AS mean_amount
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def fact_summary(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    fact = orders.join(customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    fact = fact.withColumns({
        "year": F.year("o_orderdate").cast("bigint"), "month": F.month("o_orderdate").cast("bigint")})
    return R.fact_summary(
        fact, ["year", "month", "o_orderpriority", "o_orderstatus", "c_mktsegment"], "o_orderkey", "o_totalprice")


@query("kpis", """
SELECT count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS contracts,
       sum(o_totalprice::DECIMAL(18, 2)) FILTER (WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 8)::DOUBLE AS amount,
       ((2 * sum((o_totalprice::DECIMAL(18, 2) * 100)::BIGINT) FILTER (WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 8) + count(o_totalprice) FILTER (WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 8)) // (2 * count(o_totalprice) FILTER (WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 8)))::DOUBLE / 100 AS mean_amount
FROM orders""")
def kpis(spark, sf):
    month = (F.year("o_orderdate") == 1997) & (F.month("o_orderdate") == 8)
    return table(spark, sf, "orders").agg(
        R.count_where(F.col("o_orderstatus") == "F", "o_orderkey").alias("contracts"),
        R.sum_where(month, "o_totalprice").alias("amount"),
        R.avg_where(month, "o_totalprice").alias("mean_amount"),
    )


@query("approval_ratio", """
SELECT o_orderpriority,
       round(count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') / count(o_orderkey), 6) AS approval_ratio
FROM orders GROUP BY 1""")
def approval_ratio(spark, sf):
    return R.approval_ratio(
        table(spark, sf, "orders"), F.col("o_orderstatus") == "F", "o_orderkey", ["o_orderpriority"])


@query("share_of_total", """
SELECT o_orderpriority, count(o_orderkey) AS contracts,
       round(count(o_orderkey) / (SELECT count(o_orderkey) FROM orders), 6) AS share
FROM orders GROUP BY 1""")
def share_of_total(spark, sf):
    return R.share_of_total(table(spark, sf, "orders"), "o_orderpriority", "o_orderkey")


@query("period_growth", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS s FROM orders GROUP BY 1)
SELECT period, round(s, 2) AS amount, round(s / lag(s) OVER (ORDER BY period), 6) AS growth FROM m""")
def period_growth(spark, sf):
    orders = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), "o_totalprice")
    return R.period_growth(orders, "period", "o_totalprice")


@query("distinct_dims", """
SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders""")
def distinct_dims(spark, sf):
    return R.distinct_dimension(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("calendar_dim", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)
SELECT strftime(d, '%Y-%m-%d') AS date, year(d)::BIGINT AS year, month(d)::BIGINT AS month,
       strftime(d, '%b %Y') AS month_name, day(d)::BIGINT AS day, (isodow(d) - 1)::BIGINT AS weekday,
       weekofyear(d)::BIGINT AS iso_week, quarter(d)::BIGINT AS quarter,
       'Q' || quarter(d) || '-' || year(d) AS quarter_year
FROM d""")
def calendar_dim(spark, sf):
    from ..functions.dates import calendar

    c = calendar(table(spark, sf, "orders"), "o_orderdate")
    ints = ["year", "month", "day", "weekday", "iso_week", "quarter"]
    return c.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "month_name", "quarter_year",
        *[F.col(i).cast("bigint").alias(i) for i in ints])


@query("run_totals", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS records,
       (SELECT count(*) FROM orders) AS total_records
FROM orders GROUP BY 1""")
def run_totals(spark, sf):
    days = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return R.run_totals(days, "day")


# --- star over documents as contracts -----------------------------------------------------

def _class_sql() -> str:
    whens = " ".join(
        f"WHEN {' OR '.join(f'contains(upper(text), {sql_text(w)})' for w in words)} THEN {sql_text(name)}"
        for name, words in V.CLASS_WORDS)
    return f"CASE {whens} ELSE {sql_text(V.CLASS_OTHER)} END"


_STAR_SQL = f"""
WITH c AS (
  SELECT 'N' || doc_id AS num, text, CAST(n_chars AS DOUBLE) AS amount,
         DATE '2024-01-01' + CAST(doc_id % 500 AS INTEGER) AS published, lang, source,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE quality = 1 END AS applied, quality
  FROM documents LEFT JOIN labels USING (doc_id)),
f AS (
  SELECT *, CASE WHEN applied THEN 'Sim' ELSE 'Não' END AS flag,
    {_class_sql()} AS class
  FROM c)
"""


def contracts(spark, sf):
    """documents and labels in the shape of the contract table."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels").select("doc_id", "quality")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 500).cast("int"))
    blank = F.lit(None).cast("string")
    return docs.join(labels, "doc_id", "left").select(
        F.concat(F.lit("N"), "doc_id").alias("numeroContrato"),
        F.col("text").alias("objetoContrato"),
        F.col("n_chars").cast("double").alias("valorContrato"),
        F.when(F.col("doc_id") % 2 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.lit("sem data")).alias("dataAssinatura"),
        F.date_format(day, "yyyy-MM-dd").alias("dataPublicacao"),
        F.col("doc_id").alias("sequencialContratacao"),
        F.col("source").alias("codigoUnidadeOrgao"),
        F.col("lang").alias("modalidadeLicitacao"),
        F.upper("lang").alias("modalidade_nome_dominio"),
        blank.alias("situacao_compra_nome_dominio"),
        F.col("source").alias("esfera_nome_dominio"),
        F.col("lang").alias("poder_nome_dominio"),
        F.when(F.col("doc_id") % 3 != 0, F.col("quality") == 1).alias("filtro_aplicado"),
        blank.alias("filtro_motivo"), blank.alias("filtro_grupo_matched"), blank.alias("filtro_termo_matched"),
        blank.alias("extraction_date"),
        F.year(day).alias("year"), F.month(day).alias("month"),
    )


@query("bi_fact", _STAR_SQL + """
SELECT num AS contract, amount, CASE WHEN CAST(substr(num, 2) AS BIGINT) % 2 = 0 THEN strftime(published, '%Y-%m-%d') END AS signed,
       strftime(published, '%Y-%m-%d') AS published, lang AS category, source AS unit, flag, class,
       year(published)::BIGINT AS year, month(published)::BIGINT AS month
FROM f""")
def bi_fact(spark, sf):
    from ..plans.bi_star import build_star

    f = build_star(contracts(spark, sf))["fact"]
    return f.select(
        F.col("Número do Contrato").alias("contract"), F.col("Valor do Contrato").alias("amount"),
        F.date_format("Data Assinatura", "yyyy-MM-dd").alias("signed"),
        F.date_format("Data Publicação", "yyyy-MM-dd").alias("published"),
        F.col("Modalidade").alias("category"), F.col("Código Unidade").alias("unit"),
        F.col("Filtro Aplicado").alias("flag"), F.col("Categoria Contrato").alias("class"),
        F.col("Ano").cast("bigint").alias("year"), F.col("Mês").cast("bigint").alias("month"))


@query("bi_summary", _STAR_SQL + """
SELECT year(published)::BIGINT AS year, month(published)::BIGINT AS month, lang AS category, class, source AS sphere,
       count(num) AS contracts, sum(amount::DECIMAL(18, 2))::DOUBLE AS amount, ((2 * sum((amount::DECIMAL(18, 2) * 100)::BIGINT) + count(amount)) // (2 * count(amount)))::DOUBLE / 100 AS mean_amount
FROM f GROUP BY ALL""")
def bi_summary(spark, sf):
    from ..plans.bi_star import build_star

    s = build_star(contracts(spark, sf))["summary"]
    return s.select(
        F.col("Ano").cast("bigint").alias("year"), F.col("Mês").cast("bigint").alias("month"),
        F.col("Modalidade").alias("category"), F.col("Categoria Contrato").alias("class"),
        F.col("Esfera").alias("sphere"), "contracts", "amount", "mean_amount")


@query("bi_association", _STAR_SQL + """
SELECT quarter(published)::BIGINT AS quarter, upper(lang) AS category_name, flag, count(*) AS contracts
FROM f GROUP BY ALL""")
def bi_association(spark, sf):
    from ..plans.bi_star import associate, build_star

    star = build_star(contracts(spark, sf))
    fact = associate(star["fact"].drop("Nome Modalidade"), star["modalities"], ["Modalidade"])
    fact = associate(fact, star["calendar"].select("date", "quarter"), {"Data Publicação": "date"})
    return fact.groupBy(
        F.col("quarter").cast("bigint").alias("quarter"), F.col("Nome Modalidade").alias("category_name"),
        F.col("Filtro Aplicado").alias("flag")).agg(F.count("*").alias("contracts"))


@query("stored_star", _STAR_SQL + """
SELECT quarter(published)::BIGINT AS quarter, upper(lang) AS category_name, source AS unit, class, count(*) AS contracts
FROM f GROUP BY ALL""")
def stored_star(spark, sf):
    """The star as bucketed tables; fact with calendar and modalities, counted."""
    from ..plans.bi_star import PUBLISHED, associate, drop_star, store_star

    prefix = f"star_{uuid.uuid4().hex[:8]}"
    path = work_path(spark, "star")
    try:
        star = store_star(contracts(spark, sf), path, prefix, 16)
        fact = associate(star["fact"].drop("Nome Modalidade"), star["calendar"].select("date", "quarter"), {PUBLISHED: "date"})
        fact = associate(fact, star["modalities"], ["Modalidade"])
        fact.groupBy(
            F.col("quarter").cast("bigint").alias("quarter"), F.col("Nome Modalidade").alias("category_name"),
            F.col("Código Unidade").alias("unit"), F.col("Categoria Contrato").alias("class")).agg(
            F.count("*").alias("contracts")).write.parquet(f"{path}/counts")
    finally:
        drop_star(spark, prefix)
    return spark.read.parquet(f"{path}/counts")


@query("category_classifier", _STAR_SQL + """
SELECT class, lang, count(*) AS contracts FROM f GROUP BY ALL""")
def category_classifier(spark, sf):
    from ..functions.text import classify_text

    docs = table(spark, sf, "documents")
    return docs.groupBy(classify_text("text", V.CLASS_WORDS, V.CLASS_OTHER).alias("class"), "lang").agg(
        F.count("*").alias("contracts"))
