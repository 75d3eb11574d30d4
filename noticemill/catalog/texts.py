"""Text operators over documents and parts: folding, words, lexicon, verdicts, prompts."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.text import fold_text, fold_text_exact, glob_parse, has_word, is_empty_text, preview, text_key
from ..operators import lexicon as L
from ..operators import prompts as P
from ..operators import reports as R
from ..operators import verdicts as VD
from ..plans.hybrid import hybrid_filter
from .registry import local_frame, query, sql_text, table

# A small invented lexicon for the test texts: accents, phrases, a name that is also a word,
# an empty group, a term in two groups, names of equal length.
LEXICON = {
    "ÉTION": ["ément", "èaux", "ouê"],
    "CIÓN": ["ñción", "los de", "ciónque"],
    "HEIT": ["keit", "für die", "enstück", "erst"],
    "OF THE A": ["attion to", "thwh"],
    "ERINER": [],
    "SHTHE": ["erst", "thenou", "in-the"],
    "EAUX": ["dans le", "ouère", "aille"],
}
PATTERN_EDGE = "[^\\pL\\pN_]"


def lexicon_frame(spark):
    return local_frame(spark, [
        {"group": g, "group_pos": i, "terms": t} for i, (g, t) in enumerate(LEXICON.items())
    ], [("group", pa.string()), ("group_pos", pa.int64()), ("terms", pa.list_(pa.string()))])


LEXICON_SQL = "lex(grp, grp_pos, term_pos, term) AS (VALUES " + ", ".join(
    f"({sql_text(g)}, {i}, {j}, {sql_text(t)})"
    for i, (g, terms) in enumerate(LEXICON.items()) for j, t in enumerate([g, *terms])
) + ")"
FOLD = "lower(strip_accents({}))"
_HIT_SQL = "\nUNION ALL ".join(
    f"SELECT doc_id, {sql_text(g)} AS grp, {i} AS grp_pos, {j} AS term_pos, {sql_text(t)} AS term FROM docs "
    f"WHERE regexp_matches(folded, '(^|{PATTERN_EDGE})' || {FOLD.format(sql_text(t))} || '($|{PATTERN_EDGE})')"
    for i, (g, terms) in enumerate(LEXICON.items()) for j, t in enumerate([g, *terms]))
MATCH_SQL = f"""
WITH {LEXICON_SQL},
docs AS (SELECT doc_id, lang, text, {FOLD.format('text')} AS folded FROM documents),
hit AS (
  SELECT doc_id, grp, term,
         row_number() OVER (PARTITION BY doc_id ORDER BY length(grp) DESC, grp_pos, term_pos) AS rn
  FROM ({_HIT_SQL})),
m AS (SELECT docs.*, grp, term FROM docs LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h USING (doc_id))
"""


@query("fold_text", f"SELECT doc_id, md5({FOLD.format('text')}) AS folded_md5 FROM documents")
def fold_text_query(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(fold_text("text").cast("binary")).alias("folded_md5"))


# Syllables and vowel signs that stand for letters of the texts, so that each script's decomposition is met.
COMPOSED = dict(zip("aeiou", "\uac01\ud55c\ud7a3\u09cb\u0ddd"))


def _exact_fold_sql() -> str:
    """Letters pass the fold as private marks and are then replaced by the parts of what stands for them."""
    marks = {letter: chr(0xE000 + i) for i, letter in enumerate(COMPOSED)}
    sql = FOLD.format(f"translate(text, '{''.join(marks)}', '{''.join(marks.values())}')")
    for letter, mark in marks.items():
        parts = "".join(ch for ch in unicodedata.normalize("NFD", COMPOSED[letter]) if unicodedata.category(ch) != "Mn")
        sql = f"replace({sql}, '{mark}', '{parts}')"
    return sql


@query("fold_text_exact", f"SELECT doc_id, md5({_exact_fold_sql()}) AS folded_md5 FROM documents")
def fold_text_exact_query(spark, sf):
    text = F.translate("text", "".join(COMPOSED), "".join(COMPOSED.values()))
    return table(spark, sf, "documents").select("doc_id", F.md5(fold_text_exact(text).cast("binary")).alias("folded_md5"))


@query("has_word", f"""
SELECT doc_id, regexp_matches({FOLD.format('text')}, '(^|{PATTERN_EDGE})fur die($|{PATTERN_EDGE})') AS phrase,
       regexp_matches({FOLD.format('text')}, '(^|{PATTERN_EDGE})etion($|{PATTERN_EDGE})') AS word
FROM documents""")
def has_word_query(spark, sf):
    docs = table(spark, sf, "documents").withColumn("folded", fold_text("text"))
    return docs.select("doc_id", has_word("folded", "fur die").alias("phrase"), has_word("folded", "etion").alias("word"))


@query("lexicon_first_match", MATCH_SQL + """
SELECT doc_id, grp AS matched_group, term AS matched_term, grp IS NOT NULL AS stage1_passed,
       CASE WHEN grp IS NULL THEN 'Nenhum termo correspondente encontrado'
            WHEN grp = term THEN 'Match com grupo ''' || grp || ''''
            ELSE 'Match com termo ''' || term || ''' do grupo ''' || grp || '''' END AS stage1_reason,
       CASE WHEN grp = term THEN 'Nome do grupo "' || grp || '" (palavra exata)'
            ELSE 'Termo "' || term || '" do grupo "' || grp || '" (palavra exata)' END AS criterion
FROM m""")
def lexicon_first_match(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return L.keyword_stage(docs, "text", lexicon_frame(spark)).select(
        "doc_id", "matched_group", "matched_term", "stage1_passed", "stage1_reason", "criterion")


@query("lexicon_match_joined", MATCH_SQL + "SELECT doc_id, grp AS matched_group, term AS matched_term FROM m")
def lexicon_match_joined(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return L.match_lexicon(docs, "text", lexicon_frame(spark), id_col="doc_id", inline_bound=0).select(
        "doc_id", "matched_group", "matched_term")


@query("lexicon_match_by_text", MATCH_SQL + "SELECT doc_id, grp AS matched_group, term AS matched_term FROM m")
def lexicon_match_by_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return L.match_lexicon(docs, "text", lexicon_frame(spark), inline_bound=0).select("doc_id", "matched_group", "matched_term")


@query("group_term_counts", MATCH_SQL + """
SELECT grp AS matched_group, term AS matched_term, count(*) AS docs FROM m GROUP BY 1, 2""")
def group_term_counts(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    return L.match_lexicon(docs, "text", lexicon_frame(spark)).groupBy("matched_group", "matched_term").agg(
        F.count("*").alias("docs"))


@query("hits_by_group", MATCH_SQL + """
SELECT grp AS matched_group, count(*) AS hits FROM m WHERE grp IS NOT NULL GROUP BY 1""")
def hits_by_group(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    return L.hits_per(L.match_lexicon(docs, "text", lexicon_frame(spark)), "matched_group")


@query("hits_top10", MATCH_SQL + """
SELECT term AS matched_term, count(*) AS hits FROM m WHERE grp IS NOT NULL GROUP BY 1
ORDER BY hits DESC, term LIMIT 10""")
def hits_top10(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    return L.top_hits(L.match_lexicon(docs, "text", lexicon_frame(spark)), "matched_term")


@query("lexicon_build", """
SELECT p_type AS "group", array_to_string(list_sort(list_distinct(list(lower(p_name)))), '|') AS terms
FROM part GROUP BY 1""")
def lexicon_build(spark, sf):
    built = L.build_lexicon(table(spark, sf, "part"), "p_type", "p_name")
    return built.select("group", F.array_join("terms", "|").alias("terms"))


@query("lexicon_explode", """
WITH b AS (SELECT p_type AS g, list_sort(list_distinct(list(lower(p_name)))) AS t FROM part GROUP BY 1)
SELECT g AS "group", g AS term, 0::BIGINT AS term_pos FROM b
UNION ALL
SELECT g, unnest(t), unnest(range(1, len(t) + 1))::BIGINT FROM b""")
def lexicon_explode(spark, sf):
    built = L.build_lexicon(table(spark, sf, "part"), "p_type", "p_name")
    return L.explode_lexicon(built).select("group", "term", F.col("term_pos").cast("bigint").alias("term_pos"))


@query("derived_lexicon_match", f"""
WITH b AS (SELECT DISTINCT p_type AS g, lower(p_name) AS t FROM part),
e AS (SELECT g, t FROM b UNION SELECT g, g FROM b),
r AS (SELECT g, t, row_number() OVER (ORDER BY length(g) DESC, g, CASE WHEN t = g THEN 0 ELSE 1 END, t) AS pr FROM e),
d AS (SELECT DISTINCT p_name, {FOLD.format('p_name')} AS folded FROM part),
h AS (SELECT p_name, g, t, row_number() OVER (PARTITION BY p_name ORDER BY pr) AS rn
      FROM d JOIN r ON contains(' ' || folded || ' ', ' ' || lower(t) || ' '))
SELECT p_partkey, g AS matched_group, t AS matched_term FROM part LEFT JOIN (SELECT * FROM h WHERE rn = 1) USING (p_name)""")
def derived_lexicon_match(spark, sf):
    part = table(spark, sf, "part")
    built = L.build_lexicon(part, "p_type", "p_name")
    return L.match_lexicon(part, "p_name", built).select("p_partkey", "matched_group", "matched_term")


@query("empty_text", """
SELECT conv_id, count(*) FILTER (WHERE coalesce(text, '') = '') AS empty, count(*) AS turns
FROM conversations GROUP BY 1""")
def empty_text(spark, sf):
    return table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.count(F.when(is_empty_text("text"), F.lit(1))).alias("empty"), F.count("*").alias("turns"))


@query("preview", """
SELECT doc_id, md5(CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END) AS short_md5,
       md5(CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END) AS long_md5
FROM documents""")
def preview_query(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(preview("text", 100).cast("binary")).alias("short_md5"),
        F.md5(preview("text", 200).cast("binary")).alias("long_md5"))


@query("text_key", r"""
SELECT doc_id, md5(regexp_replace(lower(text), '^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$', '', 'g')) AS key
FROM documents""")
def text_key_query(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text_key("text").alias("key"))


# --- verdicts -------------------------------------------------------------------------------
# Response texts built from labels, with the malformed kinds spread by doc_id; valid in both dialects.
RESPONSE = """CASE doc_id % 7
 WHEN 0 THEN 'sem resposta'
 WHEN 1 THEN 'DECISAO: APROVAR' || chr(10) || 'CATEGORIA: ' || lang || chr(10) || 'CONFIANCA: '
   || (50 + doc_id % 50) || '%' || chr(10) || 'JUSTIFICATIVA: objeto adequado '
 WHEN 2 THEN '  DECISÃO: rejeitar  ' || chr(10) || 'CONFIANÇA: 0' || chr(10) || 'JUSTIFICATIVA: Não se enquadra'
 WHEN 3 THEN 'DECISAO: APROVAR' || chr(10) || 'DECISAO: TALVEZ' || chr(10) || 'CONFIANCA: 72.5%'
 WHEN 4 THEN 'DECISAO: APROVAR' || chr(10) || 'DECISAO: REJEITAR' || chr(10) || 'CATEGORIA: a' || chr(10)
   || 'CATEGORIA:  b ' || chr(10) || 'CONFIANCA: 90%' || chr(10) || 'JUSTIFICATIVA: fora'
 WHEN 5 THEN 'DECISAO: ' || CASE WHEN quality = 1 THEN 'APROVAR' ELSE 'REJEITAR' END || chr(10) || 'CONFIANCA: 60 %'
 ELSE 'CONFIANCA: %' || chr(10) || 'JUSTIFICATIVA: MATERIAIS EDUCACIONAIS' END"""

RESPONSES_SQL = f"resp AS (SELECT doc_id, text, lang, quality, {RESPONSE} AS response FROM documents LEFT JOIN labels USING (doc_id))"


def parse_sql(source: str) -> str:
    return f"""
lines AS (SELECT *, [trim(x) FOR x IN string_split(response, chr(10))] AS l FROM {source}),
raw AS (SELECT *,
  [upper(trim(regexp_replace(x, 'DECISAO:|DECISÃO:', '', 'g'))) FOR x IN l IF starts_with(x, 'DECISAO:') OR starts_with(x, 'DECISÃO:')] AS ds,
  [trim(replace(x, 'CATEGORIA:', '')) FOR x IN l IF starts_with(x, 'CATEGORIA:')] AS cs,
  [trim(replace(regexp_replace(x, 'CONFIANCA:|CONFIANÇA:', '', 'g'), '%', '')) FOR x IN l
     IF starts_with(x, 'CONFIANCA:') OR starts_with(x, 'CONFIANÇA:')] AS ns,
  [trim(replace(x, 'JUSTIFICATIVA:', '')) FOR x IN l IF starts_with(x, 'JUSTIFICATIVA:')] AS js FROM lines),
parsed AS (SELECT * EXCLUDE (l, ds, cs, ns, js),
  coalesce([d FOR d IN ds IF d IN ('APROVAR', 'REJEITAR')][-1], 'REJEITAR') AS decisao,
  coalesce(cs[-1], '') AS categoria,
  CASE WHEN regexp_full_match(ns[-1], '[+-]?[0-9]+') THEN CAST(ns[-1] AS BIGINT) ELSE 0::BIGINT END AS confianca,
  coalesce(js[-1], '') AS justificativa FROM raw),
repaired AS (SELECT * REPLACE (
  CASE WHEN decisao = 'REJEITAR' AND confianca = 0 AND (contains(lower(justificativa), 'se enquadra')
       OR contains(lower(justificativa), 'materiais educacionais')) THEN 'APROVAR' ELSE decisao END AS decisao,
  CASE WHEN decisao = 'REJEITAR' AND confianca = 0 AND (contains(lower(justificativa), 'se enquadra')
       OR contains(lower(justificativa), 'materiais educacionais')) THEN 85::BIGINT ELSE confianca END AS confianca) FROM parsed)"""


def responses(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select("doc_id", "text", "lang", F.expr(RESPONSE).alias("response"))


@query("parse_verdict", f"WITH {RESPONSES_SQL}, {parse_sql('resp')} SELECT doc_id, decisao, categoria, confianca, justificativa FROM parsed")
def parse_verdict_query(spark, sf):
    return VD.parse_responses(responses(spark, sf).drop("text"), "response", repair=False).select(
        "doc_id", "decisao", "categoria", "confianca", "justificativa")


@query("verdict_repair", f"WITH {RESPONSES_SQL}, {parse_sql('resp')} SELECT decisao, confianca, count(*) AS n FROM repaired GROUP BY 1, 2")
def verdict_repair_query(spark, sf):
    return VD.parse_responses(responses(spark, sf), "response").groupBy("decisao", "confianca").agg(F.count("*").alias("n"))


# Stored verdicts: one cache row per labelled document, stored up to 59 hours before the run.
RUN_TS = "2024-02-01 00:00:00"
KEY_SQL = r"md5(regexp_replace(lower({}), '^\s+|\s+$', '', 'g'))"
CACHE_SQL = f"""cache AS (
  SELECT {KEY_SQL.format('text')} AS key, doc_id AS cache_id, {RESPONSE} AS response,
         TIMESTAMP '{RUN_TS}' - to_hours(CAST(doc_id % 60 AS INTEGER)) AS stored_at
  FROM documents JOIN labels USING (doc_id)),
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY stored_at DESC, cache_id DESC) AS rn FROM cache) WHERE rn = 1),
fresh AS (SELECT * FROM newest WHERE TIMESTAMP '{RUN_TS}' < stored_at + INTERVAL 24 HOURS)"""


def cache(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels").select("doc_id", "quality")
    stored = F.lit(RUN_TS).cast("timestamp_ntz") - F.make_dt_interval(hours=(F.col("doc_id") % 60).cast("int"))
    return docs.join(labels, "doc_id").select(
        text_key("text").alias("key"), F.expr(RESPONSE).alias("response"),
        stored.alias("stored_at"),
        # The row's id breaks ties of two verdicts stored in the same hour.
        F.col("doc_id").alias("cache_id"))


def newest_fresh(spark, sf):
    """Fresh verdicts; equal storage times are told apart by id."""
    from ..functions.dates import is_fresh
    from ..operators.dedup import latest_per_key

    newest = latest_per_key(cache(spark, sf), ["key"], [F.desc("stored_at"), F.desc("cache_id")])
    return newest.where(is_fresh("stored_at", F.lit(RUN_TS).cast("timestamp_ntz"), 24))


@query("cache_lookup", f"""
WITH {CACHE_SQL}
SELECT doc_id, cache_id, fresh.key IS NOT NULL AS cached
FROM (SELECT doc_id, {KEY_SQL.format('text')} AS key FROM documents) d LEFT JOIN fresh USING (key)""")
def cache_lookup_query(spark, sf):
    keyed = VD.with_key(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")
    return VD.cache_lookup(keyed, newest_fresh(spark, sf).select("key", "cache_id")).select("doc_id", "cache_id", "cached")


@query("uncached_keys", f"""
WITH {CACHE_SQL}
SELECT key, md5(min(text)) AS text_md5 FROM (SELECT {KEY_SQL.format('text')} AS key, text FROM documents)
WHERE key NOT IN (SELECT key FROM fresh) GROUP BY 1""")
def uncached_keys_query(spark, sf):
    keyed = VD.with_key(table(spark, sf, "documents").select("text"), "text")
    missing = VD.uncached_keys(keyed, "text", newest_fresh(spark, sf))
    return missing.select("key", F.md5(F.col("text").cast("binary")).alias("text_md5"))


HYBRID_SQL = MATCH_SQL.rstrip() + f""",
{CACHE_SQL}, {parse_sql('fresh')},
j AS (SELECT m.doc_id, m.lang, m.text, m.grp, m.term, r.decisao, r.categoria, r.confianca, r.justificativa, r.key IS NOT NULL AS has_verdict
      FROM m LEFT JOIN repaired r ON m.grp IS NOT NULL AND r.key = {KEY_SQL.format('m.text')}),
s AS (SELECT *, CASE WHEN grp IS NULL THEN 'Nenhum termo correspondente encontrado'
            WHEN grp = term THEN 'Match com grupo ''' || grp || ''''
            ELSE 'Match com termo ''' || term || ''' do grupo ''' || grp || '''' END AS why FROM j),
h AS (SELECT *, grp IS NOT NULL AND (NOT has_verdict OR decisao = 'APROVAR') AS included,
        CASE WHEN grp IS NULL THEN 'Etapa 1 (Palavras-chave): ' || why
             WHEN NOT has_verdict THEN 'Apenas Etapa 1 (Palavras-chave): ' || why
             ELSE 'Híbrido: Etapa1 ✓ → Etapa2 ' || CASE WHEN decisao = 'APROVAR' THEN '✓' ELSE '✗' END
                  || ' | LLM ' || decisao || ' (confiança: ' || confianca || '%)' END AS reason FROM s)
"""


def verdict_table(spark, sf):
    return VD.parse_responses(newest_fresh(spark, sf), "response")


@query("hybrid_filter", HYBRID_SQL + """
SELECT doc_id, included, reason, CASE WHEN grp IS NOT NULL THEN has_verdict END AS hybrid,
  CASE WHEN has_verdict THEN categoria END AS category,
  md5(CASE WHEN has_verdict AND length(text) > 200 THEN substr(text, 1, 200) || '...'
       WHEN NOT has_verdict AND length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END) AS preview_md5
FROM h""")
def hybrid_filter_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = hybrid_filter(docs, "text", lexicon_frame(spark), verdict_table(spark, sf), on_missing="keep", id_col="doc_id")
    return out.select(
        "doc_id", "included", "reason", F.col("details.filtro_hibrido").alias("hybrid"),
        F.col("details.llm_categoria").alias("category"),
        F.md5(F.col("details.objetivo_compra").cast("binary")).alias("preview_md5"))


@query("detail_merge", HYBRID_SQL + """
SELECT grp, term, has_verdict AS second, decisao AS decision, count(*) AS docs FROM h WHERE included GROUP BY ALL""")
def detail_merge(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = hybrid_filter(docs, "text", lexicon_frame(spark), verdict_table(spark, sf), on_missing="keep", kept_only=True)
    return out.groupBy(
        F.col("details.grupo_matched").alias("grp"), F.col("details.termo_matched").alias("term"),
        F.col("details.filtro_hibrido").alias("second"), F.col("details.llm_decisao").alias("decision"),
    ).agg(F.count("*").alias("docs"))


@query("filter_bypass", "SELECT lang, 'Filtro desativado' AS reason, true AS included, count(*) AS docs FROM documents GROUP BY 1")
def filter_bypass(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "text")
    return hybrid_filter(docs, "text", lexicon_frame(spark), enabled=False).groupBy("lang", "reason", "included").agg(
        F.count("*").alias("docs"))


@query("funnel_stats", HYBRID_SQL + """
SELECT *, round(100 * filtrados_aprovados / total_analisados, 2) AS taxa_aprovacao_final_percent,
  round(100 * etapa1_aprovados / total_analisados, 2) AS taxa_etapa1_aprovacao_percent,
  round(100 * llm_economizados / total_analisados, 2) AS taxa_economia_llm_percent
FROM (SELECT count(*) AS total_analisados, count(grp) AS etapa1_aprovados, count(*) - count(grp) AS etapa1_rejeitados,
  count(*) FILTER (WHERE has_verdict AND decisao = 'APROVAR') AS etapa2_aprovados,
  count(*) FILTER (WHERE has_verdict AND decisao <> 'APROVAR') AS etapa2_rejeitados,
  count(*) FILTER (WHERE included) AS filtrados_aprovados, count(*) FILTER (WHERE NOT included) AS filtrados_rejeitados,
  count(*) FILTER (WHERE grp IS NULL AND text <> '') AS llm_economizados FROM h)""")
def funnel_stats_query(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return R.funnel_stats(hybrid_filter(
        docs, "text", lexicon_frame(spark), verdict_table(spark, sf), on_missing="keep", id_col="doc_id"))


# --- model usage over events as a call log ---------------------------------------------------
PRICES = [("model-a", 0.0021, 0.0037), ("model-b", 0.017, 0.041)]
CALLS = [
    "event_id", "user_id",
    "CASE event_type WHEN 'view' THEN 'model-a' WHEN 'purchase' THEN 'model-b' ELSE 'model-x' END AS model",
    "CAST(floor(value) AS BIGINT) AS input_tokens",
    "user_id AS output_tokens",
    "value / 100 AS seconds",
    "event_type = 'click' AS cached",
    "event_type = 'error' AS failed",
    "CASE WHEN value >= 20 THEN 'APROVAR' ELSE 'REJEITAR' END AS decision",
]
COST_SQL = f"""prices(model, pin, pout) AS (VALUES {', '.join(str(p) for p in PRICES)}),
calls AS (SELECT {', '.join(CALLS)} FROM events),
cost AS (SELECT calls.*, coalesce(input_tokens / 1000 * pin::DOUBLE + output_tokens / 1000 * pout::DOUBLE, 0) AS cost_usd
         FROM calls LEFT JOIN prices USING (model))"""


def calls_with_cost(spark, sf):
    calls = table(spark, sf, "events").selectExpr(*CALLS)
    names = ("model", "input_price", "output_price")
    prices = local_frame(
        spark, [dict(zip(names, p)) for p in PRICES], list(zip(names, (pa.string(), pa.float64(), pa.float64()))))
    return VD.with_cost(calls, prices, "model", "input_tokens", "output_tokens")


@query("call_cost", f"WITH {COST_SQL} SELECT event_id, model, round(cost_usd, 9) AS cost_usd FROM cost")
def call_cost(spark, sf):
    return calls_with_cost(spark, sf).select("event_id", "model", F.round("cost_usd", 9).alias("cost_usd"))


@query("usage_stats", f"""
WITH {COST_SQL},
s AS (SELECT count(*) FILTER (WHERE NOT cached) AS total_queries,
  count(*) FILTER (WHERE NOT cached AND NOT failed AND decision = 'APROVAR') AS aprovados,
  count(*) FILTER (WHERE NOT cached AND NOT failed AND decision <> 'APROVAR') AS rejeitados,
  count(*) FILTER (WHERE cached) AS cache_hits, count(*) FILTER (WHERE NOT cached) AS cache_misses,
  (sum(input_tokens + output_tokens) FILTER (WHERE NOT cached AND NOT failed))::BIGINT AS total_tokens,
  sum(cost_usd) FILTER (WHERE NOT cached AND NOT failed) AS c, avg(seconds) FILTER (WHERE NOT cached AND NOT failed) AS t,
  count(*) FILTER (WHERE NOT cached AND failed) AS errors, count(DISTINCT user_id) AS cache_size FROM cost)
SELECT total_queries, aprovados, rejeitados, round(100 * aprovados / total_queries, 2) AS approval_rate_percent,
  cache_hits, cache_misses, round(100 * cache_hits / (cache_hits + cache_misses), 2) AS cache_hit_rate_percent,
  total_tokens, round(total_tokens / total_queries, 2) AS avg_tokens_per_query, round(c, 4) AS total_cost_usd,
  round(c / total_queries, 4) AS avg_cost_per_query, round(t, 3) AS avg_response_time_seconds, errors, cache_size FROM s""")
def usage_stats_query(spark, sf):
    calls = calls_with_cost(spark, sf).withColumn("tokens", F.col("input_tokens") + F.col("output_tokens"))
    return VD.usage_stats(
        calls, "decision", "tokens", "cost_usd", "seconds", "cached", "failed", F.countDistinct("user_id"))


# --- prompts -----------------------------------------------------------------------------------
CONTEXT_TEMPLATE = 'Grupo {group}, termo "{term}", exemplos: {examples}.\nTexto: "{text}"\nResponda no formato fixo.'
GENERIC_TEMPLATE = 'Sem grupo.\nTexto: "{text}"\nResponda no formato fixo.'
NO_EXAMPLES = "sem exemplos"


@query("prompt", MATCH_SQL.rstrip() + f""",
ex AS (SELECT grp, string_agg(term, ', ' ORDER BY term_pos) FILTER (WHERE term_pos > 0) AS examples FROM lex GROUP BY 1)
SELECT doc_id, md5(CASE WHEN m.grp IS NULL THEN 'Sem grupo.' || chr(10) || 'Texto: "' || text || '"' || chr(10) || 'Responda no formato fixo.'
  ELSE 'Grupo ' || m.grp || ', termo "' || term || '", exemplos: ' || coalesce(examples, '{NO_EXAMPLES}') || '.' || chr(10)
       || 'Texto: "' || text || '"' || chr(10) || 'Responda no formato fixo.' END) AS prompt_md5
FROM m LEFT JOIN ex USING (grp)""")
def prompt_query(spark, sf):
    lex = lexicon_frame(spark)
    matched = L.match_lexicon(table(spark, sf, "documents").select("doc_id", "text"), "text", lex)
    out = P.context_prompt(matched, "text", lex, CONTEXT_TEMPLATE, GENERIC_TEMPLATE, NO_EXAMPLES)
    return out.select("doc_id", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query("prompt_variants", """
SELECT doc_id, md5('Categorias: ' || source || ', ' || lang || chr(10) || 'Texto: ' || text) AS categorise_md5,
  md5('Refinar ' || source || ': ' || text) AS refine_md5, md5('Caso incerto: ' || text) AS uncertain_md5
FROM documents""")
def prompt_variants(spark, sf):
    docs = table(spark, sf, "documents").withColumn("found", F.array("source", "lang"))
    docs = P.categorise_prompt(docs, "text", "found", "{context}Texto: {text}", "Categorias: {categories}\n", "categorise")
    docs = P.refine_prompt(docs, "text", "source", "Refinar {category}: {text}", "refine")
    docs = P.plain_prompt(docs, "text", "Caso incerto: {text}", "uncertain")
    return docs.select("doc_id", *[
        F.md5(F.col(c).cast("binary")).alias(f"{c}_md5") for c in ("categorise", "refine", "uncertain")])


@query("batch_prompt", """
WITH n AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS p, text FROM documents)
SELECT p // 20 AS batch, count(*) AS items,
  md5('Textos:' || chr(10) || string_agg((p % 20 + 1) || '. ' || text, chr(10) ORDER BY p)) AS prompt_md5
FROM n GROUP BY 1""")
def batch_prompt_query(spark, sf):
    out = P.batch_prompt(table(spark, sf, "documents"), "doc_id", "text", 20, "Textos:\n{items}")
    return out.select("batch", "items", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query("batch_prompt_text_keys", """
WITH n AS (SELECT row_number() OVER (ORDER BY md5('k' || doc_id)) - 1 AS p, text FROM documents)
SELECT p // 20 AS batch, count(*) AS items,
  md5('Textos:' || chr(10) || string_agg((p % 20 + 1) || '. ' || text, chr(10) ORDER BY p)) AS prompt_md5
FROM n GROUP BY 1""")
def batch_prompt_text_keys(spark, sf):
    """Keys are texts in another order than the rows."""
    key = F.md5(F.concat(F.lit("k"), F.col("doc_id").cast("string")).cast("binary"))
    docs = table(spark, sf, "documents").withColumn("k", key)
    out = P.batch_prompt(docs, "k", "text", 20, "Textos:\n{items}", block_rows=500)
    return out.select("batch", "items", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query("batch_prompt_sparse", """
WITH n AS (SELECT row_number() OVER (ORDER BY (doc_id * 7919) % 1000003, doc_id) - 1 AS p, text FROM documents)
SELECT p // 20 AS batch, count(*) AS items,
  md5('Textos:' || chr(10) || string_agg((p % 20 + 1) || '. ' || text, chr(10) ORDER BY p)) AS prompt_md5
FROM n GROUP BY 1""")
def batch_prompt_sparse(spark, sf):
    """Keys far apart and in another order than the rows."""
    key = ((F.col("doc_id") * 7919) % 1_000_003) * (1 << 40) + F.col("doc_id")
    docs = table(spark, sf, "documents").withColumn("far", key)
    out = P.batch_prompt(docs, "far", "text", 20, "Textos:\n{items}")
    return out.select("batch", "items", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query("glob_parse", """
SELECT page_id, CASE WHEN regexp_matches(url, '.*?://.*?/') THEN regexp_extract(url, '(.*?)://(.*?)/(.*)', 2) END AS host,
  CASE WHEN regexp_matches(url, '.*?://.*?/') THEN regexp_extract(url, '(.*?)://(.*?)/(.*)', 3) END AS rest
FROM pages""")
def glob_parse_query(spark, sf):
    _, host, rest = glob_parse("url", "*://*/*", ["scheme", "host", "rest"])
    return table(spark, sf, "pages").select("page_id", host, rest)
