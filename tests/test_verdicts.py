from datetime import datetime

from conftest import column, plan_of
from pyspark.sql import functions as F

from noticemill.operators import verdicts as VD
from noticemill.plans.hybrid import hybrid_filter
from noticemill.operators.reports import funnel_stats
from test_lexicon import lexicon

RESPONSES = [
    ("DECISAO: APROVAR\nCATEGORIA: Papel\nCONFIANCA: 90%\nJUSTIFICATIVA: ok", ("APROVAR", "Papel", 90, "ok")),
    ("  DECISÃO: aprovar \r\nCONFIANÇA: 7 %", ("APROVAR", "", 7, "")),
    ("DECISAO: APROVAR\nDECISAO: TALVEZ", ("APROVAR", "", 0, "")),
    ("DECISAO: APROVAR\nDECISÃO: REJEITAR\nCONFIANCA: 80\nCONFIANCA: 8.5", ("REJEITAR", "", 0, "")),
    ("CATEGORIA: a\nCATEGORIA:\nCONFIANCA: -3", ("REJEITAR", "", -3, "")),
    ("x DECISAO: APROVAR\nJUSTIFICATIVA: JUSTIFICATIVA: duas", ("REJEITAR", "", 0, "duas")),
    ("CONFIANCA: +1_0", ("REJEITAR", "", 10, "")),
    ("", ("REJEITAR", "", 0, "")),
    (None, ("REJEITAR", "", 0, "")),
]


def test_parse(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RESPONSES)], "i int, r string")
    out = VD.parse_responses(df, "r", repair=False).orderBy("i").collect()
    assert [tuple(r)[2:] for r in out] == [want for _, want in RESPONSES]


def test_repair(spark):
    cases = [
        ("JUSTIFICATIVA: O item se enquadra", ("APROVAR", 85)),
        ("JUSTIFICATIVA: não SE ENQUADRA", ("APROVAR", 85)),
        ("DECISAO: REJEITAR\nCONFIANCA: 10\nJUSTIFICATIVA: se enquadra", ("REJEITAR", 10)),
        ("JUSTIFICATIVA: Materiais Educacionais", ("APROVAR", 85)),
        ("JUSTIFICATIVA: fora", ("REJEITAR", 0)),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, r string")
    out = VD.parse_responses(df, "r").orderBy("i").collect()
    assert [(r["decisao"], r["confianca"]) for r in out] == [w for _, w in cases]
    assert VD.parse_responses(df, "r", repair=False).where("decisao = 'APROVAR'").count() == 0


def test_cache_lifetime(spark):
    rows = [("a", datetime(2024, 1, 1, 0, 0, 1), 1), ("b", datetime(2024, 1, 1), 2), ("c", datetime(2023, 12, 31), 3),
            ("d", datetime(2023, 12, 1), 4), ("d", datetime(2024, 1, 1, 23), 5), ("e", None, 6)]
    cache = spark.createDataFrame(rows, "key string, stored_at timestamp_ntz, v int")
    fresh = VD.fresh_verdicts(cache, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"), 24)
    assert sorted((r["key"], r["v"]) for r in fresh.collect()) == [("a", 1), ("d", 5)]
    asked = spark.createDataFrame([(t,) for t in ("a", "b", "a", "x")], "key string").withColumn("text", F.upper("key"))
    hits = VD.cache_lookup(asked, fresh.select("key", "v")).groupBy("cached").count().collect()
    assert {r["cached"]: r["count"] for r in hits} == {True: 2, False: 2}
    assert sorted(column(VD.uncached_keys(asked, "text", fresh), "key")) == ["b", "x"]


def test_unknown_model_costs_nothing(spark):
    calls = spark.createDataFrame([("m", 1000, 500), ("?", 1000, 500), (None, 1, 1)], "model string, i long, o long")
    prices = spark.createDataFrame([("m", 0.02, 0.05)], "model string, input_price double, output_price double")
    out = VD.with_cost(calls, prices, "model", "i", "o")
    assert sorted(column(out, "cost_usd")) == [0.0, 0.0, 0.045]


def test_usage_without_calls(spark):
    none = spark.createDataFrame([], "d string, t long, c double, s double, cached boolean, failed boolean")
    r = VD.usage_stats(none, "d", "t", "c", "s", "cached", "failed", F.lit(0)).first().asDict()
    assert set(r.values()) == {0}


def hybrid_input(spark):
    texts = ["papel", "caneta azul", "bloco", "nada", "", None, "papel"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    verdicts = VD.with_key(spark.createDataFrame(
        [("PAPEL ", "APROVAR", 90), ("caneta azul", "REJEITAR", 70), ("nada", "APROVAR", 99)],
        "text string, decisao string, confianca long"), "text").drop("text")
    return df, verdicts.withColumn("categoria", F.lit("c")).withColumn("justificativa", F.lit("j"))


def test_hybrid(spark):
    df, verdicts = hybrid_input(spark)
    keep = {r["id"]: r for r in hybrid_filter(df, "text", lexicon(spark), verdicts, on_missing="keep").collect()}
    assert [keep[i]["included"] for i in range(7)] == [True, False, True, False, False, False, True]
    assert keep[0]["reason"] == "Híbrido: Etapa1 ✓ → Etapa2 ✓ | LLM APROVAR (confiança: 90%)"
    assert keep[1]["reason"] == "Híbrido: Etapa1 ✓ → Etapa2 ✗ | LLM REJEITAR (confiança: 70%)"
    assert keep[2]["reason"].startswith("Apenas Etapa 1 (Palavras-chave): Match com termo 'bloco'")
    assert keep[3]["reason"] == "Etapa 1 (Palavras-chave): Nenhum termo correspondente encontrado"
    assert keep[4]["reason"] == keep[5]["reason"] == "objetoCompra vazio"
    assert [keep[i]["details"]["filtro_hibrido"] for i in (0, 2, 3)] == [True, False, None]
    reject = hybrid_filter(df, "text", lexicon(spark), verdicts, on_missing="reject")
    assert sorted(column(reject.where("included"), "id")) == [0, 6]
    alone = hybrid_filter(df, "text", lexicon(spark))
    assert sorted(column(alone.where("included"), "id")) == [0, 1, 2, 6]
    kept = hybrid_filter(df, "text", lexicon(spark), verdicts, on_missing="keep", kept_only=True)
    assert sorted(column(kept, "id")) == [0, 2, 6]
    assert hybrid_filter(df, "text", lexicon(spark), enabled=False).where("included").count() == 7


def test_funnel(spark):
    df, verdicts = hybrid_input(spark)
    r = funnel_stats(hybrid_filter(df, "text", lexicon(spark), verdicts, on_missing="keep")).first().asDict()
    assert (r["total_analisados"], r["etapa1_aprovados"], r["etapa1_rejeitados"]) == (7, 4, 3)
    assert (r["etapa2_aprovados"], r["etapa2_rejeitados"]) == (2, 1)
    assert (r["filtrados_aprovados"], r["filtrados_rejeitados"], r["llm_economizados"]) == (3, 4, 1)
    assert r["taxa_economia_llm_percent"] == 14.29
    none = funnel_stats(hybrid_filter(df.where("false"), "text", lexicon(spark), verdicts)).first().asDict()
    assert set(none.values()) == {0}


def test_latest_verdict_is_cut_before_the_shuffle(spark):
    cache = spark.range(10).selectExpr("string(id % 3) as key", "timestamp_ntz'2024-01-01' as stored_at")
    plan = plan_of(VD.fresh_verdicts(cache, F.lit("2024-01-01").cast("timestamp_ntz")))
    assert "WindowGroupLimit" in plan and "Partial" in plan
