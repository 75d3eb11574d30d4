from datetime import date

import pytest
from conftest import column, plan_of
from pyspark.sql import functions as F

from noticemill.operators import dedup as D
from noticemill.operators import planning as P
from noticemill.operators import prompts as PR


def test_keep_last_with_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 1, "a"), (None, 2, "b"), ("k", 5, "c"), ("k", 4, "d"), ("z", None, "e")], "k string, o int, v string")
    assert sorted(column(D.dedup_keep_last(df, ["k"], ["o"]), "v")) == ["b", "c", "e"]


def test_missing_keys(spark):
    df = spark.createDataFrame([("k", 1), ("k", 2)], "k string, o int")
    with pytest.raises(ValueError, match="other"):
        D.dedup_keep_last(df, ["k", "other"], ["o"])
    assert D.dedup_keep_last(df, ["k", "other"], ["o"], require_all=False).count() == 1
    assert D.dedup_keep_last(df, ["other"], ["o"], require_all=False).count() == 2


def test_hot_key_is_cut_in_the_map_tasks(spark):
    df = spark.range(100000).select((F.col("id") % 1).alias("k"), F.col("id").alias("o"))
    out = D.dedup_keep_last(df, ["k"], ["o"])
    assert "WindowGroupLimit" in plan_of(out)
    assert column(out, "o") == [99999]


def test_union_and_upsert(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, w double")
    rows = {tuple(r) for r in D.union_all([a, b]).collect()}
    assert rows == {(1, "x", None), (1, None, 2.0), (2, None, 3.0)}
    new = spark.createDataFrame([(1, "y"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, D.upsert_by_key(a, new, ["k"]).collect())) == [(1, "y"), (3, "z")]
    assert column(D.not_in(new, a, ["k"]), "k") == [3]


@pytest.mark.parametrize("kw, want", [
    ({}, (date(2024, 1, 1), date(2024, 1, 10))),
    ({"only": date(2023, 5, 5), "historical": True}, (date(2023, 5, 5), date(2023, 5, 5))),
    ({"last_loaded": date(2024, 1, 5)}, (date(2024, 1, 9), date(2024, 1, 9))),
    ({"last_loaded": date(2024, 1, 5), "catch_up": True}, (date(2024, 1, 6), date(2024, 1, 10))),
    ({"last_loaded": date(2024, 1, 9)}, None),
    ({"last_loaded": date(2024, 1, 10), "catch_up": True}, None),
    ({"last_loaded": date(2024, 1, 9), "historical": True}, (date(2024, 1, 1), date(2024, 1, 10))),
])
def test_date_span(kw, want):
    assert P.date_span(date(2024, 1, 10), date(2024, 1, 1), **kw) == want


def test_plan_and_pending(spark):
    planned = P.plan_dates(spark, (date(2024, 2, 28), date(2024, 3, 1)))
    assert [str(d) for d in column(planned.orderBy("date"), "date")] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    done = spark.createDataFrame([(date(2024, 2, 29),), (date(2024, 2, 29),)], "date date")
    assert P.pending_dates(planned, done).count() == 2
    assert P.plan_dates(spark, None).count() == 0


def test_manifest(spark):
    totals = spark.createDataFrame([(date(2024, 1, 1), "6", 3), (date(2024, 1, 1), "8", 0)], "date date, category string, pages long")
    out = P.page_manifest(P.plan_dates(spark, (date(2024, 1, 1), date(2024, 1, 2))), ["6", "8", "9"], totals)
    assert sorted((r["start"], r["category"], r["page"], r["page_size"]) for r in out.collect()) == [
        ("20240101", "6", i, 50) for i in (1, 2, 3)]
    assert "Cartesian" not in plan_of(out)


def test_prompts(spark):
    df = spark.createDataFrame(
        [(1, "t1", "G", "x"), (2, "t2", "VAZIO", "VAZIO"), (3, "t3", None, None), (4, "t4", "?", "?")],
        "id int, text string, matched_group string, matched_term string")
    lex = spark.createDataFrame([("G", ["a", "b"]), ("VAZIO", [])], "group string, terms array<string>")
    out = PR.context_prompt(df, "text", lex, "{group}|{term}|{examples}|{text}|{group}", "só {text}", "afins").orderBy("id")
    assert column(out, "prompt") == ["G|x|a, b|t1|G", "VAZIO|VAZIO|afins|t2|VAZIO", "só t3", "só t4"]
    with pytest.raises(ValueError):
        PR.fill_template("{nada}", {})
    found = spark.createDataFrame([("t", ["A", "B"]), ("u", []), ("v", None)], "text string, c array<string>")
    out = PR.categorise_prompt(found, "text", "c", "{context}> {text}", "vistas: {categories} ")
    assert column(out, "prompt") == ["vistas: A, B > t", "> u", "> v"]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_batches_number_rows_over_blocks(spark, block):
    ids = [-5, 0, 1, 2, 7, 8, 9, 10, 999, 1000, 5000]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "id long, text string").repartition(3)
    out = PR.batch_prompt(df, "id", "text", 4, "{items}", block).orderBy("batch").collect()
    want = [ids[i:i + 4] for i in range(0, len(ids), 4)]
    assert [r["items"] for r in out] == [4, 4, 3]
    for r, chunk in zip(out, want):
        assert r["prompt"] == "\n".join(f"{n}. t{i}" for n, i in enumerate(chunk, 1))


@pytest.mark.parametrize("block", [1, 7, 100_000])
@pytest.mark.parametrize("kind", ["string", "double", "date", "decimal(20,3)", "struct<a:string,b:int>"])
def test_numbers_over_keys_of_any_type(spark, monkeypatch, block, kind):
    monkeypatch.setattr(PR, "CUT_KEYS", 16)
    made = {"string": "concat('\u00e9', id % 10, 'x', id)", "double": "id * 1e300 - 3e301", "date": "date_add(DATE '2020-01-01', CAST(id * 7 AS INT))",
            "decimal(20,3)": "CAST(id / 8 - 9 AS DECIMAL(20,3))", "struct<a:string,b:int>": "struct(concat('k', id % 3) AS a, CAST(id AS INT) AS b)"}[kind]
    df = spark.range(0, 150, 1, 5).select(F.when(F.col("id") > 0, F.expr(made)).alias("k"), "id")
    assert df.schema["k"].dataType.simpleString() == kind
    got = PR.row_position(df, "k", block).collect()
    want = [r["id"] for r in df.orderBy(F.asc_nulls_first("k")).collect()]
    assert [r["id"] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(150))
    assert PR.row_position(df.limit(0), "k", block).collect() == []


def test_numbering_runs_nothing_before_it_is_asked_for(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbering", "")
    out = PR.batch_prompt(spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("t")), "k", "t", 4, "{items}")
    assert list(tracker.getJobIdsForGroup("numbering")) == []
    assert out.count() == 13
    assert len(tracker.getJobIdsForGroup("numbering")) > 0
