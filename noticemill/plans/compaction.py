"""Old days into months, and the whole history."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.dates import is_older_than
from ..operators.dedup import dedup_keep_last, union_all
from ..sources.dataset import (
    date_of_name, delete_files, delete_path, file_names, folder_value, list_files, path_exists, read_dataset, read_files, write_monthly,
    write_text_file)


def with_partition_date(df: DataFrame, out: str = "file_date") -> DataFrame:
    """Date of the folders a row comes from; a month folder counts as its first day.

    A date the frame has already (one found in file names) stays.
    """
    if out in df.columns:
        return df
    day = F.col("day") if "day" in df.columns else F.lit(1)
    return df.withColumn(out, F.make_date("year", "month", day))


TIE = "_row_hash"


def with_tie_break(df: DataFrame) -> DataFrame:
    """Adds a hash of the row, so that equal keys and dates are put in the same order by every run."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.withColumn(TIE, F.xxhash64(*plain))


def months_with_old_days(days: DataFrame, run_ts: Column, older_than_days: int) -> DataFrame:
    """year, month, number of old days: the months to compact. Needs year, month and file_date."""
    return (
        days.where(is_older_than("file_date", run_ts, older_than_days))
        .groupBy("year", "month")
        .agg(F.countDistinct("file_date").alias("days"))
    )


def compacted(
    daily: DataFrame, monthly: DataFrame | None, run_ts: Column, older_than_days: int,
    keys: Sequence[str], order: Sequence[str] = (), require_all: bool = True,
) -> DataFrame:
    """Rows of the months to compact, de-duplicated.

    A monthly row is older than a daily one, a daily row older than one of a later day, and
    ``order`` decides inside a day, and a hash of the row where that leaves a tie. Monthly rows take part where their
    month has old days.
    """
    old = with_partition_date(daily).where(is_older_than("file_date", run_ts, older_than_days))
    parts = [old.withColumn("source_rank", F.lit(1))]
    if monthly is not None:
        months = months_with_old_days(with_partition_date(daily), run_ts, older_than_days)
        same = monthly.join(months.select("year", "month"), ["year", "month"], "left_semi")
        parts.insert(0, with_partition_date(same).withColumn("source_rank", F.lit(0)))
    rows = union_all(parts)
    month_keys = [k for k in keys if k in rows.columns]
    if not month_keys and not require_all:
        return rows.drop("source_rank", "file_date", "day")
    tied = with_tie_break(rows)
    last = dedup_keep_last(tied, [*keys, "year", "month"], ["source_rank", "file_date", *order, TIE], require_all)
    return last.drop("source_rank", "file_date", "day", TIE)


def listed_days(files: DataFrame) -> DataFrame:
    """Files of a listing with ``year, month, file_date``, of their folders or, where those name no day, of their names.

    Files without either are left out.
    """
    path = F.col("path")
    year, month, day = (folder_value(path, n) for n in ("year", "month", "day"))
    named = F.coalesce(date_of_name(F.element_at(F.split(path, "/"), -1)), date_of_name(F.element_at(F.split(path, "/"), -2)))
    dated = files.withColumn("file_date", F.coalesce(F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date"), named))
    return dated.where(F.col("file_date").isNotNull()).withColumns({
        "year": F.coalesce(year, F.year("file_date")), "month": F.coalesce(month, F.month("file_date"))})


def plan_compaction(spark: SparkSession, raw: str, run_ts: Column, older_than_days: int) -> DataFrame:
    """The files to compact: ``path, length, modificationTime, year, month, file_date`` of days older than the bound.

    Only the listing is read, neither rows nor footers.
    """
    return listed_days(list_files(spark, raw)).where(is_older_than("file_date", run_ts, older_than_days))


def _finish_compaction(spark: SparkSession, store: str, run: str) -> DataFrame:
    """Publishes a staged run: months replaced, its files deleted, its folder removed last. May be repeated from any point."""
    files = spark.read.parquet(f"{run}/files").collect()  # a path a file
    write_monthly(spark.read.parquet(f"{run}/rows"), f"{store}/consolidated")
    delete_files(spark, [r["path"] for r in files])
    days = sorted({(r["year"], r["month"], r["file_date"]) for r in files})
    delete_path(spark, run)
    months = [d[:2] for d in days]
    return spark.createDataFrame([(y, m, months.count((y, m))) for y, m in sorted(set(months))], "year int, month int, days bigint")


def compact_months(
    spark: SparkSession, store: str, run_ts: Column, older_than_days: int,
    keys: Sequence[str] = V.MONTH_DEDUP_KEYS, order: Sequence[str] = (), require_all: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Compacts old daily files of ``store``/raw-data into ``store``/consolidated and deletes exactly these files.

    The files are found by listing and frozen for the run: one that lands in an old day meanwhile stays and is merged by the next
    run. The rows are staged first (an old month is among its own inputs), then replace the months, and only after that the files go. A
    run that was lost is taken up by the next one: before its rows were whole it is dropped, after that it is published again from the
    same rows, so rows without any key are not doubled either.

    Keys the data lack are left out, but for ``require_all``; without any of them all rows stay. Without a declared ``schema`` the columns
    of all files are taken together. Returns the months and their number of days, those of a run taken up included.
    """
    runs, raw, done = f"{store}/metadata/compaction", f"{store}/raw-data", []
    for name in file_names(spark, runs):
        if path_exists(spark, f"{runs}/{name}/rows/_SUCCESS"):
            done.append(_finish_compaction(spark, store, f"{runs}/{name}"))
        else:
            delete_path(spark, f"{runs}/{name}")
    run = f"{runs}/{uuid.uuid4().hex[:12]}"
    plan_compaction(spark, raw, run_ts, older_than_days).coalesce(1).write.parquet(f"{run}/files")
    files = spark.read.parquet(f"{run}/files").select("path", "year", "month").collect()
    if not files:
        delete_path(spark, run)
        return union_all(done) if done else spark.createDataFrame([], "year int, month int, days bigint")
    daily, monthly = read_files(spark, [r["path"] for r in files], raw, schema), None
    if path_exists(spark, f"{store}/consolidated"):
        # Folder filter: months that are not compacted are not read.
        months = [F.struct(F.lit(y), F.lit(m)) for y, m in sorted({(r["year"], r["month"]) for r in files})]
        monthly = read_dataset(spark, f"{store}/consolidated", schema, all_columns=True).where(F.struct("year", "month").isin(months))
    compacted(daily, monthly, run_ts, older_than_days, keys, order, require_all).write.parquet(f"{run}/rows")
    done.append(_finish_compaction(spark, store, run))
    return union_all(done).groupBy("year", "month").agg(F.sum("days").alias("days"))


def history(
    frames: Sequence[DataFrame], run_ts: Column, keys: Sequence[str] = V.HISTORY_DEDUP_KEYS,
    order: Sequence[str] = (), require_all: bool = True,
) -> DataFrame:
    """Union of daily and monthly rows (oldest source first), de-duplicated, with the run's clock.

    Inside a source, ``order`` decides which row of a key is last, and a hash of the row where that leaves a tie.
    """
    ranked = [f.withColumn("source_rank", F.lit(i)) for i, f in enumerate(frames)]
    last = dedup_keep_last(with_tie_break(union_all(ranked)), keys, ["source_rank", *order, TIE], require_all).drop("source_rank", TIE)
    return last.withColumn(V.CONSOLIDATION_DATE, _clock(run_ts))


def _clock(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _pointer(spark: SparkSession, store: str) -> tuple[int, dict | None]:
    """Number and content of the newest version of the history; 0 and None before the first."""
    names = file_names(spark, f"{store}/history/versions")
    if not names:
        return 0, None
    lines = spark.read.text(f"{store}/history/versions/{names[-1]}", wholetext=True).first()
    return int(names[-1].split(".")[0]), json.loads(lines["value"])


def _period(df: DataFrame, keys: Sequence[str]) -> Column:
    """The month of the publication date if that is a key, else one of 64 buckets of the keys; a key the data lack counts as null."""
    there = {k: F.col(k) if k in df.columns else F.lit(None).cast("string") for k in keys}
    if "dataPublicacao" in there:
        return F.coalesce(F.regexp_replace(F.substring(there["dataPublicacao"].cast("string"), 1, 7), "[^0-9A-Za-z-]", "_"), F.lit("none"))
    return F.pmod(F.xxhash64(*there.values()), F.lit(64)).cast("string")


def read_history(spark: SparkSession, store: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The rows of the newest finished version with its run's clock, or None where there is none.

    A frame reads the folders of the version it was made for, whatever is rebuilt meanwhile.
    """
    _, now = _pointer(spark, store)
    if now is None or not now["folders"]:
        return None
    rows = read_dataset(spark, [f"{store}/history/{f}" for f in now["folders"].values()], schema, all_columns=True)
    return rows.withColumn(V.CONSOLIDATION_DATE, F.lit(now["clock"]))


def rebuild_history(
    spark: SparkSession, store: str, run_ts: Column, keys: Sequence[str] = V.HISTORY_DEDUP_KEYS,
    order: Sequence[str] = (), require_all: bool = False, schema: T.StructType | None = None, period: Column | None = None,
) -> bool:
    """Makes a new version of the history of ``store`` from its consolidated and raw folders; False where there is nothing to read.

    ``period`` must be a text of letters, digits and hyphens that depends on the keys alone (see ``_period`` for the default): rows of a key meet in one period, and only
    periods that hold rows of files that are new, changed or gone since the last version are made again; the others keep their
    folders. Folders are never written twice. The version's pointer, a small file under a new number, is written last, so readers see the old
    version or the new one. Folders of older versions stay until ``clean_history``. Keys the data lack are left out, but for ``require_all``; one
    must be there.
    """
    roots = [f"{store}/consolidated", f"{store}/raw-data"]
    listing = [list_files(spark, r).withColumn("source_rank", F.lit(i)) for i, r in enumerate(roots)]
    files = union_all(listing).select("path", "source_rank", F.concat_ws(":", "length", F.unix_micros("modificationTime")).alias("state"))
    version, before = _pointer(spark, store)
    number = version + 1
    folder = f"{store}/history/v{number}-{uuid.uuid4().hex[:8]}"

    now = files.collect()  # a row a file, as Spark's own listing has
    if not now:
        return False
    by_root = {i: [r["path"] for r in now if r["source_rank"] == i] for i in range(len(roots))}

    def rows_of(paths: dict[int, list[str]]) -> list[DataFrame]:
        out = []
        for i, root in enumerate(roots):
            if paths.get(i):
                part = with_partition_date(read_files(spark, paths[i], root, schema))
                out.append(part.withColumns({
                    "_file": F.col("_metadata.file_path"), "period": _period(part, keys) if period is None else period, "source_rank": F.lit(i)}))
        return out

    # Which periods each file holds: known of the last version for files that have not changed, read (one column) of the others.
    old = spark.read.parquet(f"{store}/history/{before['manifest']}") if before else None
    known = {(r["path"], r["state"]) for r in old.select("path", "state").distinct().collect()} if before else set()
    state = {r["path"]: r["state"] for r in now}
    fresh = {i: [p for p in ps if (p, state[p]) not in known] for i, ps in by_root.items()}
    read = union_all(rows_of(fresh)).select(F.col("_file").alias("path"), "period").distinct() if any(fresh.values()) else None
    current = spark.createDataFrame([(p, s) for p, s in state.items()], "path string, state string")
    manifest = None if read is None else current.join(read, "path", "left")
    changed = None if read is None else read.select("period")
    if old is not None:
        kept = old.join(current, ["path", "state"], "left_semi")
        gone = old.join(current, ["path", "state"], "left_anti").select("period")
        manifest = kept if manifest is None else manifest.join(kept, ["path", "state"], "left_anti").unionByName(kept)
        changed = gone if changed is None else changed.unionByName(gone)
    manifest.write.parquet(f"{folder}/manifest")
    manifest = spark.read.parquet(f"{folder}/manifest")
    periods = sorted(r["period"] for r in changed.where(F.col("period").isNotNull()).distinct().collect())
    folders = {p: f for p, f in before["folders"].items() if p not in set(periods)} if before else {}

    if periods:
        todo = spark.createDataFrame([(p,) for p in periods], "period string")
        held = {r["path"] for r in manifest.join(todo, "period", "left_semi").select("path").distinct().collect()}
        parts = rows_of({i: [p for p in ps if p in held] for i, ps in by_root.items()})
        if parts:
            rows = union_all(parts).join(F.broadcast(todo) if len(periods) <= 10_000 else todo, "period", "left_semi")
            present = [k for k in keys if k in rows.columns]
            if not present or (require_all and len(present) < len(keys)):
                raise ValueError(f"missing key columns: {sorted(set(keys) - set(present))}")
            last = dedup_keep_last(with_tie_break(rows.drop("_file")), [*present, "period"], ["source_rank", "file_date", *order, TIE])
            last.drop("source_rank", "file_date", "day", TIE).hint("rebalance", "period").write.partitionBy("period").parquet(f"{folder}/rows")
            made = {n.split("=", 1)[1] for n in file_names(spark, f"{folder}/rows")}
            folders |= {p: f"{folder.rsplit('/', 1)[1]}/rows/period={p}" for p in periods if p in made}
    clock = spark.range(1).select(_clock(run_ts)).first()[0]
    pointer = {"clock": clock, "folders": folders, "manifest": f"{folder.rsplit('/', 1)[1]}/manifest", "made": periods}
    if not write_text_file(spark, f"{store}/history/versions/{number:09d}.json", json.dumps(pointer)):
        raise RuntimeError(f"version {number} of the history was written by another run")
    return True


def clean_history(spark: SparkSession, store: str) -> list[str]:
    """Deletes folders that the newest version does not use, also those of lost runs; call it when no reader holds an older one."""
    _, now = _pointer(spark, store)
    if now is None:
        return []
    used = {f.split("/", 1)[0] for f in [*now["folders"].values(), now["manifest"]]} | {"versions"}
    unused = [n for n in file_names(spark, f"{store}/history") if n not in used]
    for n in unused:
        delete_path(spark, f"{store}/history/{n}")
    return unused
