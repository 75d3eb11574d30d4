from conftest import column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticemill import fixed_values as V
from noticemill import schemas as S
from noticemill.functions import nested as N
from noticemill.operators import enrich as E
from noticemill.sources import envelopes as EN


def test_fill_struct_missing_null_partial_and_extra(spark):
    df = spark.createDataFrame(
        [(1, ("c1", "x")), (2, None)], "id int, orgaoEntidade struct<cnpj:string,extra:string>")
    out = N.fill_record(df, S.RECORD_STRUCTS, S.RECORD_ARRAYS).orderBy("id").collect()
    assert out[0]["orgaoEntidade"].asDict() == {
        "cnpj": "c1", "esferaId": None, "poderId": None, "razaoSocial": None, "extra": "x"}
    assert out[1]["orgaoEntidade"] is not None and set(out[1]["orgaoEntidade"]) == {None}
    assert out[0]["unidadeSubRogada"] is not None and len(out[0]["unidadeSubRogada"]) == 6
    assert out[0]["amparoLegal"].asDict() == {"codigo": None, "descricao": None, "nome": None}
    assert out[0]["fontesOrcamentarias"] == []


def test_fill_array(spark):
    df = spark.createDataFrame(
        [(1, [(5, "n"), None]), (2, []), (3, None)], "id int, fontesOrcamentarias array<struct<codigo:bigint,nome:string>>")
    out = N.fill_struct_array(df, "fontesOrcamentarias", S.BUDGET_SOURCE).orderBy("id").collect()
    first, second = out[0]["fontesOrcamentarias"]
    assert first.asDict() == {"codigo": 5, "dataInclusao": None, "descricao": None, "nome": "n"}
    assert set(second) == {None}
    assert out[1]["fontesOrcamentarias"] == out[2]["fontesOrcamentarias"] == []


def test_filled_day_has_one_schema(spark, tmp_path):
    """A day whose nested fields are all null is read back with the same schema as a full day."""
    full = spark.createDataFrame([(1, ("c",))], "id int, orgaoEntidade struct<cnpj:string>")
    empty = spark.createDataFrame([(2, None)], "id int, orgaoEntidade void")
    for i, df in enumerate((full, empty)):
        N.fill_record(df, S.RECORD_STRUCTS, S.RECORD_ARRAYS).write.parquet(str(tmp_path / f"d{i}"))
    schemas = [spark.read.parquet(str(tmp_path / f"d{i}")).schema for i in (0, 1)]
    assert schemas[0] == schemas[1]


def test_merge_defaults_and_right(spark):
    df = spark.createDataFrame([(("a", None),), (None,)], "s struct<x:string,y:string>")
    out = df.select(N.merge_defaults("s", df.schema["s"].dataType, {"x": "dx", "z": 1}).alias("m")).collect()
    assert [tuple(r["m"]) for r in out] == [("a", 1, None), ("dx", 1, None)]
    left, right = {"a": F.lit(1), "b": F.lit(2)}, {"b": F.lit(None).cast("int"), "c": F.lit(3)}
    row = spark.range(1).select(N.merge_right(left, right).alias("m")).first()["m"]
    assert row.asDict() == {"a": 1, "b": 2, "c": 3}


def test_conform(spark):
    want = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("s", S.AGENCY), T.StructField("d", T.DoubleType()),
        T.StructField("new", T.StringType())])
    bad = spark.createDataFrame([("7", "x", "1.5", 1), ("q", None, None, 2)], "n string, s string, d string, gone int")
    out = N.conform(bad, want)
    assert out.schema == want
    assert [tuple(r) for r in out.collect()] == [(7, None, 1.5, None), (None, None, None, None)]
    assert N.conform(spark.range(2).select(F.lit(1).alias("other")), want).schema == want


def test_enrich_null_unknown_and_null_struct(spark):
    dim = spark.createDataFrame([("F", "Federal")], "code string, name string")
    df = spark.createDataFrame(
        [(1, ("F",)), (2, ("Z",)), (3, (None,)), (4, None)], "id int, orgaoEntidade struct<esferaId:string>")
    out = E.enrich_all(df, {"esfera": dim, "modalidade": dim}, V.DOMAIN_LOOKUPS).orderBy("id")
    assert column(out, "esfera_nome_dominio") == ["Federal", "Esfera Z", None, None]
    assert "modalidade_nome_dominio" not in out.columns


def test_domains_file(spark, tmp_path):
    (tmp_path / "d.json").write_text(
        '{"domain": "modalidade", "code": "6", "name": "P", "description": "longa"}\n'
        '{"domain": "modalidade", "code": "7", "name": "Q", "active": false}\n{"domain": "poder", "code": "E", "name": "Exec"}\n')
    from noticemill.sources.domains import read_domains

    dims = read_domains(spark, str(tmp_path / "d.json"))
    assert sorted(dims) == ["modalidade", "poder"]
    df = spark.createDataFrame([(1, "6"), (2, "7"), (3, "8")], "i int, modalidadeId string")
    out = E.enrich_all(df, dims, V.DOMAIN_LOOKUPS).orderBy("i").collect()
    assert [r["modalidade_nome_dominio"] for r in out] == ["P", "Q", "Modalidade 8"]
    assert [r["modalidade_descricao_dominio"] for r in out] == ["longa", None, "Modalidade não encontrada: 8"]
    assert column(E.with_valid_code(df, dims["modalidade"], "modalidadeId"), "i") == [1]


def test_codes(spark):
    dim = spark.createDataFrame([(1, True), (2, False)], "code int, active boolean")
    df = spark.createDataFrame([(1,), (2,), (3,), (None,), (8,)], "c int")
    assert column(E.with_valid_code(df, dim, "c"), "c") == [1]
    assert column(df.select(E.family_of("c", V.CATEGORY_FAMILIES).alias("f")), "f") == [
        "Leilão", "Procedimentos Especiais", "Licitação Tradicional", None, "Contratação Direta"]
    assert column(df.select(E.in_codes("c", V.ELECTRONIC_CODES).alias("e")), "e") == [True, False, False, False, False]


def test_envelopes(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"data": [{"numeroCompra": "1", "orgaoEntidade": {"cnpj": "9"}}, {"numeroCompra": "2"}], "totalPaginas": 1, "totalRegistros": 2}\n'
        '{"totalPaginas": 0}\n{"data": []}\n{"erro": "x"}\n')
    env = EN.read_envelopes(spark, str(tmp_path / "p.json"), S.NOTICE)
    rows = EN.explode_envelopes(env).orderBy("numeroCompra").collect()
    assert [r["numeroCompra"] for r in rows] == ["1", "2"]
    assert rows[0]["orgaoEntidade"]["cnpj"] == "9" and rows[1]["orgaoEntidade"] is None
    totals = EN.envelope_totals(env.withColumn("k", F.lit(1)), ["k"]).first()
    assert (totals["pages"], totals["records"]) == (1, 2)


def test_star_labels(spark):
    from noticemill.functions.text import yes_no
    from noticemill.functions.dates import parse_date

    df = spark.createDataFrame([(True, "2024-02-29"), (False, "2023-02-29"), (None, "x")], "b boolean, d string")
    assert column(df.select(yes_no("b", V.YES, V.NO).alias("y")), "y") == ["Sim", "Não", "Não"]
    assert [str(d) for d in column(df.select(parse_date("d").alias("d")), "d")] == ["2024-02-29", "None", "None"]


def test_record_pipeline_writes_the_contract_columns(spark):
    from noticemill.plans.records import record_pipeline
    from test_lexicon import lexicon

    raw = spark.createDataFrame([("1", "papel a4", 99), ("2", "nada", 1)], "numeroCompra string, objetoCompra string, modalidadeId long")
    dim = spark.createDataFrame([(6, "Pregão")], "code long, name string")
    out = record_pipeline(raw, "objetoCompra", lexicon(spark), {"modalidade": dim})
    row = out.first()
    assert out.count() == 1
    assert (row["filtro_aplicado"], row["filtro_grupo_matched"], row["modalidade_nome_dominio"]) == (True, "PAPEL", "Modalidade 99")
    assert set(V.FILTER_COLUMNS.values()) | set(S.RECORD_STRUCTS) | {"fontesOrcamentarias"} <= set(out.columns)
    assert len(out.columns) == 3 + 5 + 1 + 5 + 1


def test_dirty_leaves_become_null(spark):
    df = spark.createDataFrame(
        [(1, ("x7", "n"), [("8", None), ("y", "m")])], "id int, s struct<codigo:string,nome:string>, a array<struct<codigo:string,nome:string>>")
    want = T.StructType([T.StructField("codigo", T.LongType()), T.StructField("nome", T.StringType())])
    filled = N.fill_struct_array(N.fill_struct(df, "s", want), "a", want).first()
    assert tuple(filled["s"]) == (None, "n") and [tuple(e) for e in filled["a"]] == [(8, None), (None, "m")]
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("s", want), T.StructField("a", T.ArrayType(want)), T.StructField("more", want)])
    row = N.conform(df, schema).first()
    assert (row["id"], tuple(row["s"]), [tuple(e) for e in row["a"]], row["more"]) == (1, (None, "n"), [(8, None), (None, "m")], None)
    assert N.conform(df, schema).schema == schema


def test_doubled_code_multiplies_nothing(spark):
    dim = spark.createDataFrame([("a", "one"), ("a", "two"), (None, "none")], "code string, name string")
    out = E.enrich(spark.createDataFrame([("a",), ("b",), (None,)], "k string"), dim, "k", "out", "? %s").collect()
    assert sorted((r["k"] or "", r["out"]) for r in out) == [("", None), ("a", "one"), ("b", "? b")]
