import re

import re

import pyarrow as pa
import pytest
from conftest import column, plan_of
from pyspark.sql import functions as F
from test_text import folded_in_python

from noticemill import fixed_values as V
from noticemill.functions.text import fold_text_exact
from noticemill.operators import lexicon as L

GROUPS = {
    "PAPEL": ["papel sulfite", "a4", "bloco"],
    "CANETAS": ["caneta azul", "marca-texto", "bloco"],
    "TINTAS": ["bastão", "cola  quente"],
    "VAZIO": [],
    "++": ["c++", "+++", " / "],
    "CABOS": ["cabo", "ção"],
}
TEXTS = [
    "Aquisição de PAPEL e caneta azul", "caneta AZUL", "papel", "papelaria e blocos", "bloco", "um vazio qualquer",
    "cola quente", "cola  quente", "linguagem c++ x", "linguagem c++x", "x+++y", "BASTAO", "marca texto", "marca-texto", "",
    None, "   ", "cabo_1", "cabo1 e cabo", "ação", "ção", "papel² sulfite", "papel sulfite²", "tintas canetas", "évazio",
    "x +++ y", "+++y", "x+++", "a / b", "a /b", "x++y", "x\n++\ny", "c++ x++y",
]


def lexicon(spark, groups=None):
    rows = [(g, i, t) for i, (g, t) in enumerate((groups or GROUPS).items())]
    return spark.createDataFrame(rows, "group string, group_pos bigint, terms array<string>")


def texts(spark, values=None):
    return spark.createDataFrame(list(enumerate(values or TEXTS)), "id bigint, text string")


def first_in_python(text, groups):
    """Slow check: try every entry, keep the one of best rank."""
    found = []
    for pos, (group, terms) in enumerate(groups.items()):
        for inner, term in enumerate([group, *terms]):
            needle = folded_in_python(term)
            if needle and re.search(rf"\b{re.escape(needle)}\b", folded_in_python(text)):
                found.append(((-len(group), pos, inner), group, term))
    return min(found)[1:] if found else (None, None)


@pytest.mark.parametrize("bound", [2000, 0])
def test_first_match(spark, bound):
    out = L.match_lexicon(texts(spark), "text", lexicon(spark), id_col="id", inline_bound=bound)
    got = {r["id"]: (r["matched_group"], r["matched_term"]) for r in out.collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i] == first_in_python(t, GROUPS), t


@pytest.mark.parametrize("bound", [2000, 0])
def test_first_match_on_documents(spark, bound):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    groups = {"HEIT": ["für die", "keit"], "ÉTION": ["ément"], "THE OF": ["of the", "thwh"], "DANS": []}
    out = L.match_lexicon(docs, "text", lexicon(spark, groups), id_col="doc_id", inline_bound=bound)
    got = {r["doc_id"]: (r["matched_group"], r["matched_term"]) for r in out.drop("text").collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == first_in_python(r["text"], groups)


def test_stage_columns(spark):
    out = L.keyword_stage(texts(spark, ["papel", "bloco", "nada", ""]), "text", lexicon(spark)).orderBy("id").collect()
    assert [r["stage1_passed"] for r in out] == [True, True, False, False]
    assert out[0]["stage1_reason"] == "Match com grupo 'PAPEL'"
    assert out[0]["criterion"] == 'Nome do grupo "PAPEL" (palavra exata)'
    assert out[1]["stage1_reason"] == "Match com termo 'bloco' do grupo 'CANETAS'"
    assert out[1]["criterion"] == 'Termo "bloco" do grupo "CANETAS" (palavra exata)'
    assert out[2]["stage1_reason"] == "Nenhum termo correspondente encontrado"
    assert (out[3]["stage1_reason"], out[3]["preview"]) == ("objetoCompra vazio", None)


def test_empty_lexicon_matches_nothing(spark):
    none = spark.range(0).select(F.lit("").alias("group"), F.array().cast("array<string>").alias("terms"))
    assert column(L.match_lexicon(texts(spark), "text", none), "matched_group") == [None] * len(TEXTS)


def test_small_lexicon_needs_no_shuffle_and_no_join(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    matched = L.match_lexicon(docs, "text", lexicon(spark))
    plan = plan_of(matched.where("matched_group is not null"))
    assert "Exchange" not in plan and "Join" not in plan
    assert plan.count("regexp_extract_all") == plan_of(matched).count("regexp_extract_all")


def test_build_lexicon(spark):
    pairs = spark.createDataFrame(
        [("B", "Z"), ("B", "A"), ("B", "a"), ("A", "Ç")], "g string, s string")
    built = {r["group"]: r["terms"] for r in L.build_lexicon(pairs, "g", "s").collect()}
    assert built == {"B": ["a", "z"], "A": ["ç"]}


def test_lexicon_sources(spark, tmp_path):
    from noticemill.sources import lexicons as S

    (tmp_path / "pairs.csv").write_bytes("﻿Grupo;Subgrupo\nPAPEL;A4\nPAPEL;A4\nCOLA;BASTÃO\n".encode())
    assert sorted(map(tuple, S.read_pairs(spark, str(tmp_path / "pairs.csv")).collect())) == [
        ("COLA", "BASTÃO"), ("PAPEL", "A4"), ("PAPEL", "A4")]
    (tmp_path / "map.json").write_text('{\n "Z": ["a", "b"],\n "A": []\n}', encoding="utf-8")
    rows = S.read_map(spark, str(tmp_path / "map.json")).collect()
    assert [tuple(r) for r in rows] == [("Z", 0, ["a", "b"]), ("A", 1, [])]
    (tmp_path / "bad.json").write_text("[1, 2")
    assert S.read_map(spark, str(tmp_path / "bad.json")).count() == 0
    assert S.read_map(spark, str(tmp_path / "none.json")).count() == 0


def test_large_lexicon_without_id_and_hot_words(spark):
    """More entries than the inline bound, all on one common word; equal texts, no key."""
    from noticemill.plans.records import record_pipeline

    groups = {f"GRUPO {i}": [f"papel tipo{i}"] for i in range(1300)}
    values = ["compra de papel tipo7 azul", "compra de papel tipo7 azul", "papel tipo1299", "papel tipo", "grupo 12 e papel tipo5", "", None]
    out = L.match_lexicon(texts(spark, values), "text", lexicon(spark, groups))
    got = {r["id"]: (r["matched_group"], r["matched_term"]) for r in out.collect()}
    assert got == {i: first_in_python(t, groups) for i, t in enumerate(values)}
    small = {g: t for g, t in list(groups.items())[:30]}
    frames = [record_pipeline(texts(spark, values), "text", lexicon(spark, small), {}, inline_bound=b) for b in (2000, 0)]
    rows = [sorted((r["id"], r["filtro_motivo"] if "filtro_motivo" in f.columns else str(r)) for r in f.collect()) for f in frames]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_record_pipeline_without_filter(spark):
    from noticemill.plans.records import record_pipeline

    out = record_pipeline(texts(spark, ["x", None]), "text", lexicon(spark), {}, enabled=False)
    assert out.count() == 2 and set(column(out, V.FILTER_COLUMNS["reason"])) == {V.REASON_BYPASS}


def test_middle_sized_lexicon_looks_up_words(spark):
    groups = {f"G{i}": [f"w{i} x", f"w{i}"] for i in range(200)}
    values = ["w5 x", "y w199", "w7", "nothing", "g3 w1", None]
    out = L.match_lexicon(texts(spark, values), "text", lexicon(spark, groups))
    got = {r["id"]: (r["matched_group"], r["matched_term"]) for r in out.collect()}
    assert got == {i: first_in_python(t, groups) for i, t in enumerate(values)}
    assert "array_intersect" not in plan_of(out)


@pytest.mark.parametrize("id_col", [None, "id"])
def test_only_words_of_the_lexicon_travel(spark, id_col):
    """Below the exchange of (key, word) pairs stands a join with the lexicon's words, and no null test folds a text again."""
    groups = {"G": ["in the end", "the x", "-"], "THE": [], "H": ["end of"]}
    values = ["a b c d", "in the end", "end of in the", "x, the", "a-b", "", None, "in the end", "b c the x end"]
    small = spark.createDataFrame(pa.table({"group": list(groups), "group_pos": range(len(groups)), "terms": list(groups.values())}))
    out = L.match_lexicon(texts(spark, values), "text", small, id_col, inline_bound=0)
    got = {r["id"]: (r["matched_group"], r["matched_term"]) for r in out.collect()}
    assert got == {i: first_in_python(t, groups) for i, t in enumerate(values)}
    lines = plan_of(out.select("id", "matched_group")).split("\n")
    dealt = [i for i, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(\w+#\d+L?, anchor#", x)]
    assert dealt and all("LeftSemi" in "".join(lines[i: i + 6]) for i in dealt)
    assert not any("isnotnull" in x and "sha2" in x for x in lines)


@pytest.mark.parametrize("bound", [2000, 0])
def test_exact_fold_in_the_match(spark, bound):
    # A vowel sign is no word character: its entry stands only in the gap between two words.
    values = ["\uac01 \ud55c", "\u1100\u1161\u11a8", "\u09c7\u09be", "\u0995\u09cb\u0995", "\u0995\u09c7\u09be\u0995", "Ação", None, "\uac00"]
    groups = {"G": ["\uac01", "\u09cb"], "ACAO": []}
    out = L.match_lexicon(texts(spark, values), "text", lexicon(spark, groups), inline_bound=bound, fold=fold_text_exact)
    got = {r["id"]: (r["matched_group"], r["matched_term"]) for r in out.collect()}
    assert [got[i] for i in range(len(values))] == [first_in_python(v, groups) for v in values]
    assert [g for g, _ in got.values()].count("G") == 4
    plain = L.match_lexicon(texts(spark, values), "text", lexicon(spark, groups), inline_bound=bound)
    assert {r["id"]: r["matched_group"] for r in plain.collect()}[1] is None
