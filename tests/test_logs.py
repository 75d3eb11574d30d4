import bisect
import random
from datetime import datetime, timedelta

import pytest
from conftest import column, plan_of
from pyspark.sql import functions as F

from noticemill.operators import logs as L

T0 = datetime(2024, 1, 1)


def test_trailing_against_every_pair(spark):
    rng = random.Random(3)
    rows = [(c, T0 + timedelta(seconds=rng.choice([0, 1, 30, 59, 60, 61, 599, 600, 601, 1199]) + rng.randrange(3) * 600))
            for c in ("a", "b") for _ in range(150)]
    rows += [("c", T0), ("c", T0 + timedelta(seconds=60)), ("c", T0 + timedelta(seconds=119, microseconds=999999))]
    df = spark.createDataFrame(rows, "c string, t timestamp_ntz")
    for chunk in (60, 100, 600):
        out = L.trailing_requests(df, "t", "c", 60, chunk).collect()
        assert sum(r["requests"] for r in out) == len(rows)
        for r in out:
            want = sum(1 for c, t in rows if c == r["client"] and timedelta(0) <= r["ts"] - t < timedelta(seconds=60))
            assert r["trailing"] == want


def test_trailing_of_dense_points_looks_at_no_span(spark):
    """Many points in one span: each count is a running sum, as a frame of the span would cost its square."""
    rng = random.Random(4)
    at = sorted(rng.randrange(-90_000_000, 90_000_000) for _ in range(3000))
    rows = [("a", datetime(1970, 1, 1) + timedelta(microseconds=us)) for us in at] + [("a", None), (None, T0), (None, T0)]
    out = L.trailing_requests(spark.createDataFrame(rows, "c string, t timestamp_ntz"), "t", "c", 20, 30)
    assert "rangeframe, unboundedpreceding" in plan_of(out).lower()
    got = {(r["client"], r["ts"]): (r["requests"], r["trailing"]) for r in out.collect()}
    want = {("a", datetime(1970, 1, 1) + timedelta(microseconds=us)): (
        at.count(us), bisect.bisect_right(at, us) - bisect.bisect_right(at, us - 20_000_000)) for us in at}
    assert got == want | {(None, T0): (2, 2)}


def test_rate_report(spark):
    df = spark.createDataFrame([("a", T0 + timedelta(seconds=i)) for i in range(10)], "c string, t timestamp_ntz")
    r = L.rate_report(L.trailing_requests(df, "t", "c", 5), 4).first()
    assert (r["requests"], r["peak"], r["over_limit"]) == (10, 5, 6)


def test_alert_thresholds_and_empty_bins(spark):
    rows = [(T0 + timedelta(minutes=m), 1) for m in (0, 1, 2, 3, 4, 20, 21)] + [(T0 + timedelta(minutes=40), None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v int")
    over = L.threshold_alerts(df, "t", "v", "5 minutes", "sum", ">", 5)
    at = L.threshold_alerts(df, "t", "v", "5 minutes", "sum", ">=", 5)
    assert over.count() == 0
    assert [(r["bin"], r["value"]) for r in at.collect()] == [(T0, 5)]
    low = L.threshold_alerts(df, "t", "v", "5 minutes", "sum", ">=", 0)
    assert sorted(column(low, "bin")) == [T0, T0 + timedelta(minutes=20)]
    mean = L.threshold_alerts(df, "t", F.col("v") * 10, "10 minutes", "avg", ">", 9)
    assert mean.count() == 2


def test_lines(spark):
    rows = [
        (T0, "LLM APROVAR: a... (Confiança: 9%, Tokens: 10, Custo: $0.0100)"),
        (T0 + timedelta(minutes=4), "LLM REJEITAR: b... (Confiança: 9%, Tokens: 30, Custo: $0.0200)"),
        (T0 + timedelta(minutes=5), "LLM sem números"),
        (T0 + timedelta(minutes=6), "Modalidade 6: 120 registros em 3 páginas"),
        (T0 + timedelta(minutes=7), "Modalidade 6: 1 registros em 1 páginas"),
        (T0 + timedelta(minutes=8), "Erro na requisição"),
        (T0 + timedelta(minutes=90), "ERROR x"),
        (T0 + timedelta(minutes=91), "Traceback y"),
        (T0 + timedelta(minutes=92), "error in lower case"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, ts timestamp_ntz, m string")
    usage = L.usage_by_bin(df, "ts", "m").collect()
    assert [tuple(r) for r in usage] == [(T0 + timedelta(minutes=5), None, None), (T0, 20.0, 0.03)]
    cats = L.records_by_category(df, "m").collect()
    assert [tuple(r) for r in cats] == [("6", 121, 4), (None, None, None)]
    errors = L.errors_by_bin(df, "ts", "m").collect()
    assert [tuple(r) for r in errors] == [(T0 + timedelta(hours=1), 2)]
    latest = L.latest_errors(df, "ts", "m", "id", 5)
    assert column(latest, "m") == ["ERROR x"]
    assert "TakeOrderedAndProject" in plan_of(latest)
    assert sum(column(df.select(L.any_term_metric("m", ["quota", "ERROR"]).alias("x")), "x")) == 1


def test_share_and_growth(spark):
    from noticemill.operators import reports as R

    df = spark.createDataFrame([("a", "2024-01", 10.0), ("a", "2024-03", 0.0), ("b", "2024-04", 5.0), ("b", "2024-04", None)],
                               "k string, p string, v double")
    share = {r["k"]: r["share"] for r in R.share_of_total(df, "k", "v").collect()}
    assert share == {"a": 0.666667, "b": 0.333333}
    growth = R.period_growth(df, "p", "v").orderBy("p").collect()
    assert [(r["amount"], r["growth"]) for r in growth] == [(10.0, None), (0.0, 0.0), (5.0, None)]
    assert R.approval_ratio(df.where("false"), F.lit(True), "k").first()[0] is None


def test_streams_in_append_mode_emit_closed_bins(spark, tmp_path):
    from noticemill.sources.log_lines import read_logs
    from noticemill.streaming.log_bins import usage_bins

    src = str(tmp_path / "logs")
    df = spark.createDataFrame(
        [(T0 + timedelta(minutes=m), f"LLM ok (Tokens: {m}, Custo: $1.50)") for m in range(0, 60)], "ts timestamp, message string")
    df.write.json(src)
    stream = usage_bins(read_logs(spark, src, streaming=True), "ts", "message")
    q = stream.writeStream.format("memory").queryName("bins").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = {r["bin"]: (r["avg_tokens"], r["total_cost"]) for r in spark.table("bins").collect()}
    assert rows[T0] == (2.0, 7.5)
    # Ten minutes are allowed for late lines: later bins stay open.
    assert max(rows) < T0 + timedelta(minutes=50)


def test_alarms_as_rows(spark):
    data = [(datetime(2024, 1, 1, 0, m), a, b) for m, a, b in ((0, 1.0, None), (4, 2.0, 10.0), (5, 0.5, 30.0), (9, None, None), (20, -7.0, 1.0))]
    points = spark.createDataFrame(data, "t timestamp_ntz, a double, b double")
    rules = L.alarm_rules(spark, {
        "more": ("a", "5 minutes", "sum", ">", 3), "at_least": ("a", "5 minutes", "sum", ">=", 3), "mean": ("b", "10 minutes", "avg", ">=", 20),
        "less": ("a", "5 minutes", "sum", "<", 0), "at_most": ("b", "1 day", "avg", "<=", 1), "unknown": ("c", "1 hour", "sum", ">", 0)})
    out = L.evaluate_alarms(points, "t", {"a": F.col("a"), "b": F.col("b")}, rules)
    assert sorted((r["alarm"], r["bin"].strftime("%H:%M"), r["value"]) for r in out.collect()) == [
        ("at_least", "00:00", 3.0), ("less", "00:20", -7.0), ("mean", "00:00", 20.0)]
    assert L.evaluate_alarms(points.limit(0), "t", {"a": F.col("a")}, rules).count() == 0
    for bad in (("a", "5 minutes", "max", ">", 1), ("a", "5 minutes", "sum", "!=", 1), ("a", "0 hours", "sum", ">", 1)):
        with pytest.raises(ValueError):
            L.alarm_rules(spark, {"x": bad})


def test_all_alarms_are_read_in_one_scan(spark):
    from conftest import plan_of

    from noticemill.catalog.logging import alarm_table

    assert plan_of(alarm_table(spark, "/root/testdata/sf0.001")).count("FileScan") == 1


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, 0.7, 0.15] * 30
    df = spark.createDataFrame([(v,) for v in values], "v double")
    results = {df.orderBy(F.rand(i)).repartition(i + 1).agg(L.exact_sum("v").cast("double"), L.exact_mean("v")).first() for i in range(4)}
    assert len(results) == 1
