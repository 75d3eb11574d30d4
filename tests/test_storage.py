from datetime import date, datetime

import pytest
from conftest import column, plan_of
from pyspark.sql import functions as F

from noticemill.plans import compaction as C
from noticemill.plans.daily_load import processed_dates, run_daily_load
from noticemill.sources import dataset as DS
from noticemill.sources import json_store as J

ROWS = [(1, date(2024, 1, 30), "a"), (2, date(2024, 1, 31), "b"), (3, date(2024, 2, 1), "c"), (4, date(2024, 2, 20), "d")]


def rows(spark, data=ROWS):
    return spark.createDataFrame(data, "id long, d date, v string")


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_day_is_replaced_and_empty_input_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "daily")
    DS.write_daily(rows(spark), path, "d")
    DS.write_daily(rows(spark, [(9, date(2024, 1, 31), "new")]), path, "d")
    DS.write_daily(rows(spark, []), path, "d")
    stored = DS.read_dataset(spark, path)
    assert sorted(column(stored, "id")) == [1, 3, 4, 9]
    january = stored.where("year = 2024 and month = 1")
    assert "PartitionFilters: [isnotnull(year" in plan_of(january)
    assert january.count() == 2


def test_declared_schema_and_corrupt_files(spark, tmp_path):
    path = tmp_path / "daily"
    DS.write_daily(rows(spark), str(path), "d")
    (path / "year=2024" / "month=2" / "day=1" / "bad.parquet").write_text("not parquet")
    schema = rows(spark).schema
    with pytest.raises(Exception):
        DS.read_dataset(spark, str(path), schema).count()
    assert sorted(column(DS.read_dataset(spark, str(path), schema, skip_corrupt=True), "id")) == [1, 2, 3, 4]


def test_file_dates(spark):
    names = ["x_20240131.parquet", "x_20240231.parquet", "x_202402_consolidated.parquet", "x_abc.parquet", "x_2024.parquet", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    assert [str(d) for d in column(df.select(DS.date_of_name("n").alias("d")), "d")] == [
        "2024-01-31", "None", "2024-02-01", "None", "None", "None"]


def test_cutoff(spark):
    from noticemill.functions.dates import is_older_than

    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),)], "d date")
    assert column(df.select(is_older_than("d", ts("2024-01-31 00:00:00"), 30).alias("o")), "o") == [False, False]
    assert column(df.select(is_older_than("d", ts("2024-01-31 00:00:01"), 30).alias("o")), "o") == [True, False]


def test_compaction(spark, tmp_path):
    store = str(tmp_path)
    DS.write_daily(rows(spark, [*ROWS, (1, date(2024, 1, 31), "a2")]), f"{store}/raw-data", "d")
    DS.write_monthly(rows(spark, [(1, date(2024, 1, 1), "old"), (7, date(2024, 1, 1), "kept"), (8, date(2023, 12, 1), "other")]),
                     f"{store}/consolidated", "d")
    done = C.compact_months(spark, store, ts("2024-02-25 00:00:00"), 20, ["id"])
    assert sorted(tuple(r) for r in done.collect()) == [(2024, 1, 2), (2024, 2, 1)]
    monthly = {(r["id"], r["v"]) for r in DS.read_dataset(spark, f"{store}/consolidated").collect()}
    # The later day wins over the earlier one, a day over the month; the other month is untouched.
    assert monthly == {(1, "a2"), (2, "b"), (3, "c"), (7, "kept"), (8, "other")}
    assert column(DS.read_dataset(spark, f"{store}/raw-data"), "id") == [4]
    again = C.compact_months(spark, store, ts("2024-02-25 00:00:00"), 20, ["id"])
    assert again.count() == 0
    assert DS.read_dataset(spark, f"{store}/consolidated").count() == 5

    assert C.rebuild_history(spark, store, ts("2024-02-25 00:00:00"), ["id"])
    first = C.read_history(spark, store)
    assert sorted(column(first, "id")) == [1, 2, 3, 4, 7, 8]
    assert set(column(first, "consolidation_date")) == {"2024-02-25T00:00:00.000000"}
    assert not C.rebuild_history(spark, str(tmp_path / "none"), ts("2024-02-25 00:00:00"))


def contracts(spark, data):
    """(key, publication day, value, folder day)"""
    return spark.createDataFrame(data, "sequencialContratacao long, dataPublicacao string, v string, d date")


def test_late_files_stay_for_the_next_compaction(spark, tmp_path, monkeypatch):
    store, run = str(tmp_path), ts("2024-02-25 00:00:00")
    DS.write_daily(contracts(spark, [(1, "2024-01-03", "a", date(2024, 1, 3)), (1, "2024-01-03", "b", date(2024, 1, 4))]), f"{store}/raw-data", "d")
    finish = C._finish_compaction

    def late_file_first(*args):
        late = contracts(spark, [(1, "2024-01-03", "late", date(2024, 1, 4)), (2, "2024-01-04", "late", date(2024, 1, 4))]).drop("d")
        late.write.mode("append").parquet(f"{store}/raw-data/year=2024/month=1/day=4")
        return finish(*args)

    monkeypatch.setattr(C, "_finish_compaction", late_file_first)
    C.compact_months(spark, store, run, 20)
    monkeypatch.undo()
    assert column(DS.read_dataset(spark, f"{store}/consolidated"), "v") == ["b"]
    assert sorted(column(DS.read_dataset(spark, f"{store}/raw-data"), "v")) == ["late", "late"]
    assert [tuple(r) for r in C.compact_months(spark, store, run, 20).collect()] == [(2024, 1, 1)]
    assert sorted(column(DS.read_dataset(spark, f"{store}/consolidated"), "v")) == ["late", "late"]
    assert not list((tmp_path / "raw-data").rglob("*.parquet")) and not DS.file_names(spark, f"{store}/metadata/compaction")


@pytest.mark.parametrize("lost_at", ["rows", "publish", "delete"])
def test_compaction_is_taken_up_from_every_crash_point(spark, tmp_path, monkeypatch, lost_at):
    """Without any key a second compaction of the same file would double its rows."""
    store, run = str(tmp_path), ts("2024-02-25 00:00:00")
    DS.write_daily(rows(spark, ROWS), f"{store}/raw-data", "d")
    DS.write_monthly(rows(spark, [(7, date(2024, 1, 1), "old")]), f"{store}/consolidated", "d")

    def lost(*args, **kw):
        raise RuntimeError("lost")

    step = {"rows": "compacted", "publish": "write_monthly", "delete": "delete_files"}[lost_at]
    monkeypatch.setattr(C, step, lost)
    with pytest.raises(RuntimeError):
        C.compact_months(spark, store, run, 20, ["absent"])
    monkeypatch.undo()
    for _ in range(2):
        C.compact_months(spark, store, run, 20, ["absent"])
        assert sorted(column(DS.read_dataset(spark, f"{store}/consolidated"), "id")) == [1, 2, 3, 7]
        assert column(DS.read_dataset(spark, f"{store}/raw-data"), "id") == [4]
    assert not DS.file_names(spark, f"{store}/metadata/compaction")


def test_history_versions(spark, tmp_path):
    store = str(tmp_path)
    day = lambda d, m=1: date(2024, m, d)
    assert C.read_history(spark, store) is None
    DS.write_daily(contracts(spark, [(1, "2024-01-03", "a", day(3)), (2, "2024-02-01", "b", day(1, 2)), (3, None, "c", day(3))]), f"{store}/raw-data", "d")
    DS.write_monthly(contracts(spark, [(1, "2024-01-03", "older", day(1)), (4, "2024-01-09", "d", day(1))]), f"{store}/consolidated", "d")
    assert C.rebuild_history(spark, store, ts("2024-03-01 00:00:00"))
    first = C.read_history(spark, store)
    values = lambda df: sorted((r["sequencialContratacao"], r["v"], r["consolidation_date"][:10]) for r in df.collect())
    was = [(1, "a", "2024-03-01"), (2, "b", "2024-03-01"), (3, "c", "2024-03-01"), (4, "d", "2024-03-01")]
    assert values(first) == was
    # A file of another folder month holds a row of January: January is made again, and February not.
    DS.write_daily(contracts(spark, [(1, "2024-01-03", "new", day(7, 3))]), f"{store}/raw-data", "d")
    assert C.rebuild_history(spark, store, ts("2024-04-01 00:00:00"))
    _, pointer = C._pointer(spark, store)
    assert pointer["made"] == ["2024-01"] and pointer["folders"]["2024-02"].startswith("v1-")
    assert values(first) == was  # a reader of the old version is not disturbed
    assert values(C.read_history(spark, store)) == [
        (1, "new", "2024-04-01"), (2, "b", "2024-04-01"), (3, "c", "2024-04-01"), (4, "d", "2024-04-01")]
    # A file that goes takes its rows with it, and a lost run leaves readers what they had.
    DS.delete_files(spark, [r["path"] for r in DS.list_files(spark, f"{store}/raw-data").where("path like '%month=2%'").collect()])
    (tmp_path / "history" / "v3-lost" / "rows").mkdir(parents=True)
    assert len(C.read_history(spark, store).collect()) == 4
    assert C.rebuild_history(spark, store, ts("2024-05-01 00:00:00"))
    assert [r[0] for r in values(C.read_history(spark, store))] == [1, 3, 4]
    assert C._pointer(spark, store)[1]["made"] == ["2024-02"]
    assert C.rebuild_history(spark, store, ts("2024-06-01 00:00:00")) and C._pointer(spark, store)[1]["made"] == []
    assert "v3-lost" in C.clean_history(spark, store)
    assert [r[0] for r in values(C.read_history(spark, store))] == [1, 3, 4]
    other = str(tmp_path / "other")
    DS.write_daily(rows(spark), f"{other}/raw-data", "d")
    with pytest.raises(ValueError):
        C.rebuild_history(spark, other, ts("2024-06-01 00:00:00"), ["absent"])
    assert C.read_history(spark, other) is None


def test_two_writers_of_one_version(spark, tmp_path):
    assert DS.write_text_file(spark, f"{tmp_path}/x/1.json", "a") and not DS.write_text_file(spark, f"{tmp_path}/x/1.json", "b")
    assert (tmp_path / "x" / "1.json").read_text() == "a" and DS.file_names(spark, f"{tmp_path}/x") == ["1.json"]


def test_files_with_different_columns_and_padded_folders(spark, tmp_path):
    """Columns of all files are kept, and folders are removed as they are named."""
    store = str(tmp_path / "my store")
    raw = f"{store}/raw-data"
    rows(spark, ROWS[:1]).drop("d").write.parquet(f"{raw}/year=2024/month=01/day=30")
    rows(spark, ROWS[1:2]).select("id", F.lit(5.0).alias("extra")).write.parquet(f"{raw}/year=2024/month=01/day=31")
    C.compact_months(spark, store, ts("2024-03-25 00:00:00"), 20, ["id"])
    got = DS.read_dataset(spark, f"{store}/consolidated").orderBy("id").select("id", "v", "extra", "month").collect()
    assert [tuple(r) for r in got] == [(1, "a", None, 1), (2, None, 5.0, 1)]
    assert not list((tmp_path / "my store" / "raw-data").rglob("*.parquet"))


def test_compaction_of_named_files(spark, tmp_path):
    """Days told apart by file names instead of folders."""
    for day, data in (("30", [(1, "a"), (2, "b")]), ("31", [(1, "c")])):
        spark.createDataFrame(data, "id int, v string").write.parquet(
            f"{tmp_path}/year=2024/month=1/contratos_202401{day}.parquet")
    files = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path))
    daily = DS.with_file_date(files).withColumns({"year": F.year("file_date"), "month": F.month("file_date")})
    out = C.compacted(daily, None, ts("2024-03-25 00:00:00"), 20, ["id"])
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [(1, "c"), (2, "b")]


def test_compaction_without_keys(spark):
    daily = rows(spark).withColumns({"year": F.year("d"), "month": F.month("d"), "day": F.dayofmonth("d")})
    run = ts("2025-01-01 00:00:00")
    with pytest.raises(ValueError):
        C.compacted(daily, None, run, 1, ["sequencialContratacao"])
    assert C.compacted(daily, None, run, 1, ["sequencialContratacao"], require_all=False).count() == 4


def test_json_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert J.load_json(spark, path, "k string, v long") is None
    J.upsert_json(spark.createDataFrame([("a", 1), ("é", 2)], "k string, v long"), path, ["k"])
    J.upsert_json(spark.createDataFrame([("a", 3)], "k string, v long"), path, ["k"])
    assert sorted((r["k"], r["v"]) for r in J.load_json(spark, path, "v long").collect()) == [("a", 3), ("é", 2)]


def test_daily_load_modes(spark, tmp_path):
    store = str(tmp_path)
    source = rows(spark, [(i, date(2024, 1, d), "x") for i, d in enumerate((1, 1, 2, 4, 6))])

    def load(day, **kw):
        return {str(r["date"]): r["records"] for r in run_daily_load(
            spark, store, source, "d", lambda df: df, datetime(2024, 1, day, 8), date(2024, 1, 1), **kw).collect()}

    assert load(2) == {"2024-01-01": 2, "2024-01-02": 1}
    assert load(3) == {}  # yesterday is loaded already
    assert load(5) == {"2024-01-04": 1}  # yesterday only; the third stays open
    assert load(6, catch_up=True) == {"2024-01-05": 0, "2024-01-06": 1}
    assert load(6, historical=True) == {"2024-01-03": 0} | {"2024-01-05": 0, "2024-01-06": 1}
    assert load(7, only=date(2024, 1, 3)) == {}
    assert processed_dates(spark, store).count() == 6
    stored = DS.read_dataset(spark, f"{store}/raw-data")
    assert stored.count() == 5 and {"extraction_date", "data_publicacao"} <= set(stored.columns)


def test_stream_load_is_incremental(spark, tmp_path):
    from noticemill.streaming.incremental import load_new_files

    src, target, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        stream = spark.readStream.schema("id long, d date, v string").parquet(src)
        load_new_files(stream, lambda df: df, "d", target, cp)
        return sorted(column(DS.read_dataset(spark, target), "id"))

    rows(spark, ROWS[:2]).write.mode("append").parquet(src)
    assert run() == [1, 2]
    # A second file of the same day adds to it.
    rows(spark, [(5, date(2024, 1, 31), "e")]).write.mode("append").parquet(src)
    assert run() == [1, 2, 5]
    assert run() == [1, 2, 5]


def test_newest_files(spark, tmp_path):
    import os

    for i in range(7):
        (tmp_path / f"f{i}").write_text("x" * i)
        os.utime(tmp_path / f"f{i}", (1000 + i, 1000 + i))
    got = DS.newest_files(spark, str(tmp_path), 5)
    assert [p[-2:] for p in column(got, "path")] == ["f6", "f5", "f4", "f3", "f2"]


def test_work_folder_is_the_sessions_own(spark):
    from noticemill.session import work_path, work_root

    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_rewrite_can_be_repeated_from_every_crash_point(spark, tmp_path):
    from pyspark.sql import types as T

    from noticemill.sources import dataset as DS

    path, backup = str(tmp_path / "data"), str(tmp_path / "backup")
    rows = spark.createDataFrame([(1, "7", 2024), (2, "x", 2025)], "id long, n string, year int")
    rows.write.partitionBy("year").parquet(path)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("id", T.LongType()), T.StructField("year", T.IntegerType())])
    want = [(1, 7, 2024), (2, None, 2025)]
    (tmp_path / "backup").mkdir()  # lost before the copy was finished
    for lost in ("copy", "rewrite", "nothing"):
        if lost == "rewrite":  # only part of the new data had been written
            rows.where("id = 1").write.mode("overwrite").partitionBy("year").parquet(path)
        assert DS.rewrite_to_schema(spark, path, schema, backup, ["year"]) == 2
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "n", "year").collect()) == want
        assert (tmp_path / "data" / "year=2024").is_dir()
    assert sorted(column(spark.read.parquet(backup), "n")) == ["7", "x"]


def test_closed_bins_come_out_once_and_leave_the_state(spark):
    from noticemill.catalog import storing
    from noticemill.session import work_path
    from noticemill.streaming.log_bins import alarm_windows, late_groups, open_state

    source = storing.append_source(spark, "/root/testdata/sf0.001", work_path(spark, "append-source"))
    out, progress = storing.run_append(spark, alarm_windows(source, "ts", "1 hour", storing.append_alarms()))
    assert out.count() == out.select("alarm", "bin").distinct().count() > 100
    assert late_groups(progress) > 0 and open_state(progress) <= 1  # the bin of the closing row


def test_a_repeated_batch_shows_up_once(spark, tmp_path, monkeypatch):
    from noticemill.streaming import incremental as I

    src, target, cp, ledger = (str(tmp_path / n) for n in ("in", "out", "cp", "ledger"))

    def load():
        I.load_new_files(spark.readStream.schema("id long, d date, v string").parquet(src), lambda df: df.where("v <> 'no'"), "d", target, cp, ledger=ledger)

    rows(spark, ROWS[:2]).coalesce(1).write.parquet(src)
    load()
    rows(spark, [(8, date(2024, 2, 2), "e"), (9, date(2024, 2, 2), "no")]).coalesce(1).write.mode("append").parquet(src)
    monkeypatch.setattr(I, "path_exists", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the entry")))
    with pytest.raises(Exception):
        load()
    monkeypatch.undo()
    assert spark.read.parquet(target).count() == 3 and sorted(column(I.read_loaded(spark, target, ledger), "id")) == [1, 2]
    load()
    assert sorted(column(I.read_loaded(spark, target, ledger), "id")) == [1, 2, 8]
    rows(spark, [(10, date(2024, 2, 3), "no")]).coalesce(1).write.mode("append").parquet(src)
    load()
    state = I.run_state(spark, ledger).first()
    assert (state["batches"], state["rows"], str(state["first_day"]), str(state["last_day"])) == (3, 3, "2024-01-30", "2024-02-02")
    assert I.run_state(spark, str(tmp_path / "none")).first()["batches"] == 0


def test_daily_load_statistics(spark, tmp_path):
    """Marks of all rows make the figures; the log of a lost run is made again."""
    store = str(tmp_path)
    source = rows(spark, [(i, date(2024, 1, 1 + i % 2), v) for i, v in enumerate(["a", "a", "b", "", "c", "c"])])

    def judge(df):
        known = F.col("v").isin("a", "b")
        return df.withColumns({
            "included": F.col("v") == "a", "text_empty": F.col("v") == "", "stage1_passed": known,
            "stage2_passed": F.when(known, F.col("v") == "a"), "matched_group": F.when(known, F.col("v")), "matched_term": F.when(known, F.lit("t")),
            "details": F.struct(F.when(known, F.lit(5).cast("bigint")).alias("llm_tokens_used"), F.when(known, F.col("id") == 1).alias("llm_cached"))})

    def finish(kept):
        return kept.select("id", "d", "v")

    log = {r["date"].day: r for r in run_daily_load(
        spark, store, source, "d", finish, datetime(2024, 1, 3, 8), date(2024, 1, 1), judge=judge).collect()}
    assert {d: r["records"] for d, r in log.items()} == {1: 1, 2: 1, 3: 0} and log[3]["filter_stats"] is None
    first = log[1]["filter_stats"]
    assert (first["total_analisados"], first["etapa1_aprovados"], first["etapa2_rejeitados"], first["llm_economizados"]) == (3, 2, 1, 1)
    assert first["taxa_aprovacao_final_percent"] == 33.33 and first["filtro_hibrido_ativo"]
    assert [tuple(x) for x in first["top_grupos"]] == [("a", 1), ("b", 1)] and [tuple(x) for x in first["top_termos"]] == [("t", 2)]
    assert tuple(first["llm_stats"]) == (2, 0, 10)
    second = log[2]["filter_stats"]
    assert (second["total_analisados"], second["llm_economizados"], tuple(second["llm_stats"])) == (3, 1, (1, 1, 5))
    assert not [n for n in DS.file_names(spark, spark.conf.get("spark.checkpoint.dir")) if n.startswith("judged")]


def test_bad_files_are_listed_and_left_out(spark, tmp_path):
    path = tmp_path / "daily"
    DS.write_daily(rows(spark), str(path), "d")
    rows(spark, []).coalesce(1).write.parquet(str(path / "year=2024" / "month=3" / "day=1"))  # sound, without rows
    sound = DS.list_files(spark, str(path)).count()
    assert DS.unreadable_files(spark, str(path)).count() == 0
    day = path / "year=2024" / "month=2" / "day=1"
    good = next(f for f in day.iterdir() if f.name.startswith("part")).read_bytes()
    (day / "a.parquet").write_text("not parquet, but longer than twelve bytes")
    (day / "b.parquet").write_bytes(b"PAR1")
    (day / "c.parquet").write_bytes(b"")
    (day / "d with blank.parquet").write_bytes(good[:len(good) // 2])
    (day / "e.parquet").write_bytes(b"PAR1" + b"x" * 50 + (40).to_bytes(4, "little") + b"PAR1")
    (day / "f.parquet").write_bytes(b"PAR1" + b"x" * 50 + (2**32 - 1).to_bytes(4, "little") + b"PAR1")
    kept, skipped = DS.read_sound_files(spark, str(path))
    assert sorted(column(kept, "id")) == [1, 2, 3, 4]
    assert set(DS.DAY_PARTITIONS) <= set(kept.columns)
    errors = {r["path"].rsplit("/", 1)[1]: r["error"] for r in skipped.collect()}
    assert sorted(errors) == ["a.parquet", "b.parquet", "d%20with%20blank.parquet", "e.parquet", "f.parquet"]
    assert all(errors[f"{n}.parquet"].startswith("no footer") for n in "abf")
    assert not errors["e.parquet"].startswith("no footer")
    assert DS.list_files(spark, str(path)).count() == sound + 5


def test_nothing_to_skip(spark, tmp_path):
    assert DS.unreadable_files(spark, str(tmp_path / "none")).collect() == []
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "x.parquet").write_text("x")
    kept, skipped = DS.read_sound_files(spark, str(tmp_path / "only"), rows(spark).schema)
    assert kept.count() == 0 and skipped.count() == 1
    with pytest.raises(ValueError):
        DS.read_sound_files(spark, str(tmp_path / "only"))


def test_projected_partitions(spark, tmp_path):
    path = str(tmp_path / "months")
    DS.write_monthly(rows(spark), path, "d")
    DS.write_monthly(rows(spark, [(7, date(2031, 1, 1), "outside")]), path, "d")
    schema = spark.read.parquet(path).schema
    try:
        for last, found in ((date(2024, 1, 31), [1, 2]), (date(2024, 4, 1), [1, 2, 3, 4])):
            DS.create_projected_table(spark, "projected_test", path, schema, date(2023, 12, 5), last)
            assert sorted(column(spark.table("projected_test"), "id")) == found
        assert spark.sql("SHOW PARTITIONS projected_test").count() == 5
        february = spark.table("projected_test").where("year = 2024 and month = 2")
        assert sorted(column(february, "id")) == [3, 4]
        assert all("/month=2/" in f for f in february.inputFiles()) or "PartitionFilters: [isnotnull(year" in plan_of(february)
        assert spark.table("projected_test").where("month = 4").count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS projected_test")


def test_projected_padded_days(spark, tmp_path):
    for d, v in (("05", "a"), ("17", "b")):
        spark.createDataFrame([(v,)], "v string").write.parquet(str(tmp_path / "days" / "2024" / "03" / d))
    schema = spark.createDataFrame([], "v string, year int, month int, day int").schema
    try:
        n = DS.create_projected_table(
            spark, "padded_test", str(tmp_path / "days"), schema, date(2024, 3, 1), date(2024, 3, 31), DS.DAY_PARTITIONS,
            "{year}/{month:02d}/{day:02d}", at_once=7)
        assert n == 31
        assert [tuple(r) for r in spark.table("padded_test").orderBy("day").collect()] == [("a", 2024, 3, 5), ("b", 2024, 3, 17)]
    finally:
        spark.sql("DROP TABLE IF EXISTS padded_test")


def contract_rows(spark, n):
    from noticemill.plans.bi_star import FACT_NAMES

    kinds = {"valorContrato": "CAST(id AS DOUBLE)", "dataPublicacao": "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN '2024-02-29' ELSE string(date_add(DATE '2024-01-01', CAST(id % 90 AS INT))) END",
             "filtro_aplicado": "id % 2 = 0", "year": "2024", "month": "CAST(id % 3 AS INT)"}
    return spark.range(n).select(*[F.expr(kinds.get(c, f"concat('{c}', id % 4)")).alias(c) for c in FACT_NAMES])


def test_stored_star_reads_its_source_once_and_joins_without_a_shuffle(spark, tmp_path):
    from noticemill.plans import bi_star as B

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    contracts = contract_rows(spark, 300).withColumn("objetoContrato", counted(F.col("objetoContrato")).alias("o"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        star = B.store_star(contracts, str(tmp_path / "star"), "star_test", 4)
        assert seen.value == 300
        plain = B.build_star(contract_rows(spark, 300))
        for name, df in plain.items():
            assert sorted(map(tuple, star[name].select(*df.columns).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = B.associate(star["fact"], star["calendar"], {B.PUBLISHED: "date"})
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert joined.count() == 300 and joined.where("quarter is null").count() == 28
        again = B.store_star(contract_rows(spark, 20), str(tmp_path / "star"), "star_test", 4)
        assert again["fact"].count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        B.drop_star(spark, "star_test")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("star_test")]
