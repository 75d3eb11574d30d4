"""Look-ups, nested columns, envelopes and page planning over customers, orders and conversations."""

from __future__ import annotations

from datetime import timedelta

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from .. import schemas as S
from ..functions import nested as N
from ..functions.text import yes_no
from ..operators import enrich as E
from ..operators import planning as PL
from ..plans import records as R
from ..sources import envelopes as EN
from .registry import local_frame, query, table
from .texts import HYBRID_SQL, lexicon_frame, verdict_table

# Codes of the test tables; some are left out so that the fallback is used.
STATUS = [("O", "Aberta", True), ("F", "Concluída", False)]
PRIORITY = [("1-URGENT", 1), ("2-HIGH", 4), ("3-MEDIUM", 6), ("4-NOT SPECIFIED", 8), ("5-LOW", 99)]


def status_dim(spark):
    return local_frame(
        spark, [{"code": c, "name": n, "active": a} for c, n, a in STATUS],
        [("code", pa.string()), ("name", pa.string()), ("active", pa.bool_())])


def modality(priority: str):
    """Modality code that stands for an order priority."""
    code = F.lit(None).cast("bigint")
    for name, number in PRIORITY:
        code = F.when(F.col(priority) == name, F.lit(number).cast("bigint")).otherwise(code)
    return code


MODALITY_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{n}' THEN {c}" for n, c in PRIORITY) + " END"


@query("domain_enrich", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'O' THEN 'Aberta' WHEN 'F' THEN 'Concluída' ELSE 'Situação ' || o_orderstatus END AS status_name,
  coalesce(n_name, 'Modo ' || (o_custkey % 40)) AS mode_name
FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 40""")
def domain_enrich(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 40).alias("mode"))
    nation = E.domain_table(table(spark, sf, "nation"), "n_nationkey", "n_name")
    out = E.enrich(orders, status_dim(spark), "o_orderstatus", "status_name", "Situação %s")
    return E.enrich(out, nation, "mode", "mode_name", "Modo %s").select("o_orderkey", "status_name", "mode_name")


def agencies(spark, sf):
    """customers with an agency struct that is null for one customer in nine."""
    agency = F.struct(
        F.col("c_name").alias("cnpj"), F.col("c_nationkey").cast("string").alias("esferaId"),
        F.substring("c_mktsegment", 1, 1).alias("poderId"), F.col("c_mktsegment").alias("razaoSocial"))
    return table(spark, sf, "customer").withColumn(
        "orgaoEntidade", F.when(F.col("c_custkey") % 9 != 0, agency))


@query("nested_lookup", """
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN coalesce(r_name, 'Esfera ' || c_nationkey) END AS sphere_name,
  CASE WHEN c_custkey % 9 <> 0 THEN 'Poder ' || substr(c_mktsegment, 1, 1) END AS power_name
FROM customer LEFT JOIN region ON r_regionkey = c_nationkey""")
def nested_lookup(spark, sf):
    spheres = E.domain_table(
        table(spark, sf, "region").withColumn("code", F.col("r_regionkey").cast("string")), "code", "r_name")
    powers = E.domain_table(
        local_frame(spark, [{"code": "-", "name": "-"}], [("code", pa.string()), ("name", pa.string())]), "code", "name")
    out = E.enrich_all(agencies(spark, sf), {"esfera": spheres, "poder": powers}, V.DOMAIN_LOOKUPS)
    return out.select(
        "c_custkey", F.col("esfera_nome_dominio").alias("sphere_name"), F.col("poder_nome_dominio").alias("power_name"))


@query("active_codes", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def active_codes(spark, sf):
    return E.with_valid_code(table(spark, sf, "orders"), status_dim(spark), "o_orderstatus").select(
        "o_orderkey", "o_orderstatus")


@query("code_sets", f"""
SELECT {MODALITY_SQL} IN (1, 4, 6) AS electronic, {MODALITY_SQL} IN (5, 7, 13) AS in_person,
  CASE WHEN o_orderstatus = 'F' THEN 'Sim' ELSE 'Não' END AS flag, count(*) AS orders
FROM orders GROUP BY 1, 2, 3""")
def code_sets(spark, sf):
    orders = table(spark, sf, "orders").select(modality("o_orderpriority").alias("code"), "o_orderstatus")
    return orders.groupBy(
        E.in_codes("code", V.ELECTRONIC_CODES).alias("electronic"), E.in_codes("code", V.IN_PERSON_CODES).alias("in_person"),
        yes_no(F.col("o_orderstatus") == "F", V.YES, V.NO).alias("flag")).agg(F.count("*").alias("orders"))


@query("category_family", f"""
SELECT CASE WHEN {MODALITY_SQL} IN (3, 4, 5, 6, 7) THEN 'Licitação Tradicional' WHEN {MODALITY_SQL} IN (1, 13) THEN 'Leilão'
  WHEN {MODALITY_SQL} IN (2, 10, 11, 12) THEN 'Procedimentos Especiais' WHEN {MODALITY_SQL} IN (8, 9) THEN 'Contratação Direta'
  END AS family, count(*) AS orders FROM orders GROUP BY 1""")
def category_family(spark, sf):
    orders = table(spark, sf, "orders").select(modality("o_orderpriority").alias("code"))
    return orders.groupBy(E.family_of("code", V.CATEGORY_FAMILIES).alias("family")).agg(F.count("*").alias("orders"))


@query("family_join", """
SELECT r_name AS family, count(*) AS customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def family_join(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    # Region to its nations: a list per region, bounded by the number of nations.
    families = nation.groupBy("n_regionkey").agg(F.collect_set("n_nationkey").alias("codes")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    codes = E.family_table(families, "r_name")
    out = E.lookup(table(spark, sf, "customer"), codes, "c_nationkey", {"family": "family"})
    return out.groupBy("family").agg(F.count("*").alias("customers"))


@query("struct_fill", """
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS cnpj,
  CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS name, NULL::VARCHAR AS uf, 0::BIGINT AS sources, true AS whole
FROM customer""")
def struct_fill(spark, sf):
    # The unit and the array are missing columns here, the agency is null for some rows.
    out = N.fill_record(agencies(spark, sf), S.RECORD_STRUCTS, S.RECORD_ARRAYS)
    whole = F.col("orgaoEntidade").isNotNull() & F.col("unidadeOrgao").isNotNull() & F.col("amparoLegal").isNotNull()
    return out.select(
        "c_custkey", F.col("orgaoEntidade.cnpj").alias("cnpj"), F.col("orgaoEntidade.razaoSocial").alias("name"),
        F.col("unidadeOrgao.ufSigla").alias("uf"), F.size("fontesOrcamentarias").cast("bigint").alias("sources"),
        whole.alias("whole"))


@query("array_fill", """
WITH e AS (
  SELECT l_orderkey, l_linenumber, l_partkey, i FROM lineitem, (VALUES (0), (1), (2)) v(i)
  WHERE l_returnflag <> 'A')  -- the array of these rows is null and becomes empty
SELECT l_orderkey, l_linenumber, l_partkey, i::BIGINT AS position,
  CASE WHEN i <> 1 THEN l_partkey + i END AS codigo, CASE WHEN i <> 1 THEN 'F' || i END AS nome, NULL::VARCHAR AS descricao
FROM e""")
def array_fill(spark, sf):
    def element(i):
        return F.struct((F.col("l_partkey") + i).alias("codigo"), F.lit(f"F{i}").alias("nome"))

    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").withColumn(
        "fontes", F.when(F.col("l_returnflag") != "A", F.array(element(0), F.lit(None), element(2))))
    filled = N.fill_struct_array(items, "fontes", S.BUDGET_SOURCE)
    return filled.select("l_orderkey", "l_linenumber", "l_partkey", F.posexplode("fontes").alias("position", "e")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("position").cast("bigint").alias("position"),
        "e.codigo", "e.nome", "e.descricao")


@query("defaults_merge", """
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name ELSE 'sem cnpj' END AS cnpj,
  CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS name, 'XX' AS uf FROM customer""")
def defaults_merge(spark, sf):
    df = agencies(spark, sf)
    merged = N.merge_defaults("orgaoEntidade", df.schema["orgaoEntidade"].dataType, {"cnpj": "sem cnpj", "uf": "XX"})
    return df.withColumn("m", merged).select(
        "c_custkey", F.col("m.cnpj").alias("cnpj"), F.col("m.razaoSocial").alias("name"), F.col("m.uf").alias("uf"))


CONFORMED = T.StructType([
    T.StructField("c_custkey", T.StringType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("c_acctbal", T.LongType()),
    T.StructField("segment", T.LongType()),
    T.StructField("orgaoEntidade", T.StructType([
        T.StructField("razaoSocial", T.StringType()), T.StructField("uf", T.StringType()),
        T.StructField("cnpj", T.StringType())])),
])


@query("conform_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, NULL::DOUBLE AS balance, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal,
  NULL::BIGINT AS segment, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS name, NULL::VARCHAR AS uf FROM customer""")
def conform_schema(spark, sf):
    wrong = agencies(spark, sf).withColumn("segment", F.col("c_mktsegment"))
    return N.conform(wrong, CONFORMED).select(
        "c_custkey", "balance", "c_acctbal", "segment", F.col("orgaoEntidade.razaoSocial").alias("name"),
        F.col("orgaoEntidade.uf").alias("uf"))


TURN = T.StructType([
    T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("model", T.StringType())])


def payloads(spark, sf, page_size: int = 3):
    """Conversations as landed pages of JSON; a page holds at most ``page_size`` turns."""
    turns = table(spark, sf, "conversations").withColumn("page", F.floor(F.col("turn") / page_size))
    pages = turns.groupBy("conv_id", "page").agg(
        F.collect_list(F.struct("turn", "role", "text")).alias("data"), F.count("*").alias("totalRegistros"))
    return pages.select(
        "conv_id", "page",
        F.to_json(F.struct("data", F.lit(1).alias("totalPaginas"), "totalRegistros")).alias("payload"))


@query("envelope_ingest", """
SELECT conv_id, turn // 3 AS page, turn, role, md5(text) AS text_md5, NULL::VARCHAR AS model FROM conversations""")
def envelope_ingest(spark, sf):
    records = EN.explode_envelopes(EN.parse_envelopes(payloads(spark, sf), "payload", TURN))
    return records.select(
        "conv_id", "page", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"), "model")


@query("envelope_totals", """
SELECT conv_id, 1::BIGINT AS pages, max(n) AS records
FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id, turn // 3) GROUP BY 1""")
def envelope_totals(spark, sf):
    return EN.envelope_totals(EN.parse_envelopes(payloads(spark, sf), "payload", TURN), ["conv_id"])


def order_span(spark, sf):
    """First and last day of the orders, none of an empty table."""
    return table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()


@query("page_manifest", """
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS category, ceil(count(*) / 2)::BIGINT AS pages
           FROM orders GROUP BY 1, 2)
SELECT strftime(d, '%Y%m%d') AS start, category, unnest(range(1, pages + 1)) AS page
FROM t""")
def page_manifest(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"), "o_orderpriority")
    totals = orders.groupBy("date", F.col("o_orderpriority").alias("category")).agg(
        F.ceil(F.count("*") / 2).alias("pages"))
    first, last = order_span(spark, sf)
    dates = PL.plan_dates(spark, first and PL.date_span(last, first, historical=True))
    manifest = PL.page_manifest(dates, [p for p, _ in PRIORITY] + ["6-NONE"], totals, 2)
    return manifest.select("start", "category", "page")


@query("pending_dates", """
SELECT strftime(d, '%Y-%m-%d') AS date FROM (
  SELECT unnest(range(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) + INTERVAL 31 DAY, INTERVAL 1 DAY))::DATE AS d FROM orders)
WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def pending_dates(spark, sf):
    first, last = order_span(spark, sf)
    planned = PL.plan_dates(spark, first and PL.date_span(last + timedelta(30), first))
    done = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return PL.pending_dates(planned, done).select(F.date_format("date", "yyyy-MM-dd").alias("date"))


def record_rows(spark, sf):
    """Documents as records through the whole record pipeline."""
    from ..plans.records import record_pipeline

    docs = table(spark, sf, "documents")
    agency = F.struct(F.col("source").alias("cnpj"), F.upper(F.substring("lang", 1, 1)).alias("esferaId"))
    raw = docs.select(
        "doc_id", F.col("text").alias("objetoCompra"), (F.col("doc_id") % 15).alias("modalidadeId"),
        F.when(F.col("doc_id") % 4 != 0, agency).alias("orgaoEntidade"))
    nation = E.domain_table(table(spark, sf, "nation").where("n_nationkey < 12"), "n_nationkey", "n_name")
    spheres = local_frame(spark, [{"code": "E", "name": "Estadual"}, {"code": "F", "name": "Federal"}],
                          [("code", pa.string()), ("name", pa.string())])
    return record_pipeline(
        raw, "objetoCompra", lexicon_frame(spark), {"modalidade": nation, "esfera": spheres},
        verdict_table(spark, sf), on_missing="keep")


@query("record_pipeline", HYBRID_SQL + """
SELECT doc_id, true AS applied, reason, grp AS matched_group, term AS matched_term,
  coalesce(n_name, 'Modalidade ' || (doc_id % 15)) AS modality_name,
  CASE WHEN doc_id % 4 <> 0 THEN CASE upper(substr(lang, 1, 1)) WHEN 'E' THEN 'Estadual' WHEN 'F' THEN 'Federal'
    ELSE 'Esfera ' || upper(substr(lang, 1, 1)) END END AS sphere_name,
  CASE WHEN doc_id % 4 <> 0 THEN source END AS cnpj, NULL::VARCHAR AS uf, 0::BIGINT AS sources
FROM h JOIN documents USING (doc_id, lang) LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON n_nationkey = doc_id % 15
WHERE included""")
def record_pipeline_query(spark, sf):
    names = V.FILTER_COLUMNS
    return record_rows(spark, sf).select(
        "doc_id", F.col(names["applied"]).alias("applied"), F.col(names["reason"]).alias("reason"),
        F.col(names["group"]).alias("matched_group"), F.col(names["term"]).alias("matched_term"),
        F.col("modalidade_nome_dominio").alias("modality_name"), F.col("esfera_nome_dominio").alias("sphere_name"),
        F.col("orgaoEntidade.cnpj").alias("cnpj"), F.col("unidadeOrgao.ufSigla").alias("uf"),
        F.size("fontesOrcamentarias").cast("bigint").alias("sources"))


DIRTY = T.StructType([T.StructField("codigo", T.LongType()), T.StructField("nome", T.StringType())])


def dirty_rows(spark, sf):
    """Orders with a struct and an array whose code leaf is text that is not always a number."""
    code = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x"), F.col("o_orderkey"))).otherwise(F.col("o_orderkey").cast("string"))
    leaf = F.struct(code.alias("codigo"), F.col("o_orderstatus").alias("nome"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, leaf).alias("amparoLegal"), F.array(leaf).alias("fontes"))


DIRTY_SQL = "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END"


@query("fill_dirty_leaf", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN {DIRTY_SQL} END AS codigo,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS nome, {DIRTY_SQL} AS fonte FROM orders""")
def fill_dirty_leaf(spark, sf):
    out = N.fill_record(dirty_rows(spark, sf), {"amparoLegal": DIRTY}, {"fontes": DIRTY})
    return out.select("o_orderkey", "amparoLegal.codigo", "amparoLegal.nome", F.col("fontes")[0]["codigo"].alias("fonte"))


@query("conform_nested_drift", f"""
SELECT o_orderkey::INTEGER AS o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN {DIRTY_SQL} END AS codigo,
       o_orderkey % 5 = 0 AS absent, {DIRTY_SQL} AS fonte FROM orders""")
def conform_nested_drift(spark, sf):
    schema = T.StructType([
        T.StructField("o_orderkey", T.IntegerType()), T.StructField("amparoLegal", DIRTY), T.StructField("fontes", T.ArrayType(DIRTY))])
    out = N.conform(dirty_rows(spark, sf), schema)
    return out.select(
        "o_orderkey", "amparoLegal.codigo", F.col("amparoLegal").isNull().alias("absent"), F.col("fontes")[0]["codigo"].alias("fonte"))


@query("record_bypass", f"""
SELECT doc_id, '{V.REASON_BYPASS}' AS reason, '' AS matched_group FROM documents""")
def record_bypass(spark, sf):
    names = V.FILTER_COLUMNS
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("objetoCompra"))
    out = R.record_pipeline(docs, "objetoCompra", lexicon_frame(spark), {}, enabled=False)
    return out.select("doc_id", F.col(names["reason"]).alias("reason"), F.col(names["group"]).alias("matched_group"))
