import hashlib
import re
import sys
import unicodedata

from conftest import column, plan_of
from pyspark.sql import functions as F

from noticemill.functions import text as X


def folded_in_python(t):
    marks_out = [ch for ch in unicodedata.normalize("NFD", t or "") if unicodedata.category(ch) != "Mn"]
    return "".join(marks_out).lower()


def test_fold_every_character(spark):
    """All characters except those with a base of several characters."""
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    plain = [c for c in chars if len([p for p in unicodedata.normalize("NFD", c) if unicodedata.category(p) != "Mn"]) <= 1]
    df = spark.createDataFrame([(f"x{c}y",) for c in plain if unicodedata.category(c) != "Cn"], "t string")
    rows = df.select("t", X.fold_text("t").alias("f")).collect()
    wrong = [r["t"] for r in rows if r["f"] != folded_in_python(r["t"])]
    # Java and Python may know case pairs of different Unicode versions.
    assert len(wrong) < 20, wrong


def test_fold_full_takes_every_script(spark):
    texts = ["한국어 가각", "Ação É", "", None, "ো"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert column(df.select(X.fold_text_full("t").alias("f")), "f") == [folded_in_python(t) for t in texts]


# Code points whose lower case Spark knows otherwise than this Python (fixed values).
OTHER_CASE: set[int] = set()


def test_exact_fold_every_character(spark):
    """All assigned characters, those with a base of several characters among them."""
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(f"x{c}y",) for c in chars if unicodedata.category(c) != "Cn"], "t string")
    rows = df.select("t", X.fold_text_exact("t").alias("f")).collect()
    assert {ord(r["t"][1]) for r in rows if r["f"] != folded_in_python(r["t"])} == OTHER_CASE


def test_exact_fold_of_texts(spark):
    texts = ["한국어 가각", "Ação É", "", None, "ো", "\U00011347\U0001133e \U0001134b", "a", "ΟΔΟΣ", "각 É \U0001d160x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert column(df.select(X.fold_text_exact("t").alias("f")), "f") == [folded_in_python(t) for t in texts]


def test_exact_fold_looks_characters_up_by_code(spark):
    """No map whose keys are scanned for every character, and a derived text is made once a row."""
    df = spark.createDataFrame([("aa\ud55c x",), ("\u09cb\U0001d160",), (None,)], "t string")
    out = df.select("t", X.fold_text_exact(F.translate("t", "a", "\uac01")).alias("f"))
    got = {r["t"]: r["f"] for r in out.collect()}
    assert got == {t: folded_in_python(t and t.replace("a", "\uac01")) for t in got}
    plan = plan_of(out)
    assert "try_element_at" not in plan and plan.count("translate(t#") == 1


def test_fold_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("AÇÃO e ímã",)], "t string")
    assert column(df.select(X.fold_text("t").alias("f")), "f") == ["", "", "  ", "acao e ima"]


def test_has_word_against_python(spark):
    texts = ["papel a4", "papelaria", "papel²", "papel_a4", "papel-a4", "(papel)", "o papel", "papel", "opapel", "papel1",
             "evaé papel", "épapel", "c++ x", "c++x", "a.b papel", "pasta  l", "pasta l", "", "x\npapel\ny", "\\E papel"]
    terms = ["papel", "a4", "c++", "+x", "pasta  l", "a.b", "-a4", "\\E", "eva"]
    df = spark.createDataFrame([(t, w) for t in texts for w in terms], "t string, w string")
    for r in df.select("t", "w", X.has_word("t", F.col("w")).alias("hit")).collect():
        want = bool(r["t"]) and bool(re.search(r"\b" + re.escape(r["w"]) + r"\b", r["t"]))
        assert r["hit"] == want, (r["t"], r["w"])


def test_has_word_empty_term(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    assert column(df.select(X.has_word("t", "").alias("h")), "h") == [False]


def test_text_key_ignores_case_and_outer_space(spark):
    texts = [" Caneta Azul ", "caneta azul", " CANETA AZUL\n", "caneta  azul", "\x1cÇa\t"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    keys = column(df.select(X.text_key("t").alias("k")), "k")
    assert keys == [hashlib.md5(t.lower().strip().encode()).hexdigest() for t in texts]
    assert keys[0] == keys[1] == keys[2] != keys[3]


def test_empty_text(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("a",)], "t string")
    assert column(df.select(X.is_empty_text("t").alias("e")), "e") == [True, True, False, False]


def test_preview(spark):
    df = spark.createDataFrame([("a" * 100,), ("é" * 101,), (None,)], "t string")
    assert column(df.select(X.preview("t", 100).alias("p")), "p") == ["a" * 100, "é" * 100 + "...", None]


def test_contains_and_matches(spark):
    df = spark.createDataFrame([("Sistema novo",), ("INFORMAÇÃO",), (None,), ("informacao",)], "t string")
    assert column(df.select(X.contains_any_lower("t", ["sistema", "informacao"]).alias("h")), "h") == [True, False, False, True]
    assert column(df.select(X.matches_any("t", ["^sis", "ão$"]).alias("h")), "h") == [True, True, False, False]


def test_classify(spark):
    from noticemill import fixed_values as V

    df = spark.createDataFrame([("reforma da rede",), ("Construção",), ("limpeza",), ("papel",), ("partida",), (None,)], "t string")
    got = column(df.select(X.classify_text("t", V.CLASS_WORDS, V.CLASS_OTHER).alias("c")), "c")
    # The second rule hits inside words too, as "TI" in "partida".
    assert got == ["Tecnologia da Informação", "Obras e Infraestrutura", "Serviços Gerais", "Outros",
                   "Tecnologia da Informação", "Outros"]


def test_glob_parse(spark):
    from noticemill import fixed_values as V

    lines = ["LLM REJEITAR: x... (Confiança: 10%, Tokens: 42, Custo: $0.0012)", "nada", None]
    df = spark.createDataFrame([(m,) for m in lines], "m string")
    rows = df.select(*X.glob_parse("m", V.USAGE_GLOB, ["tokens", "cost"], ["tokens", "cost"])).collect()
    assert [tuple(r) for r in rows] == [(42.0, 0.0012), (None, None), (None, None)]
    raw = df.select(*X.glob_parse("m", V.USAGE_GLOB, ["tokens", "cost"])).first()
    assert tuple(raw) == ("42", "0.0012)")
