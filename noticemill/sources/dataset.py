"""Partitioned Parquet datasets: read, date discovery, daily and monthly writes, tables, rewrites."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.dates import partition_columns
from ..functions.nested import conform

DAY_PARTITIONS = ("year", "month", "day")
MONTH_PARTITIONS = ("year", "month")


def read_dataset(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
    base_path: str | None = None, skip_corrupt: bool = False, all_columns: bool = False,
) -> DataFrame:
    """Scan of a partitioned dataset; filters on the folder columns prune folders.

    A declared schema is used as it is. Without one the columns are those of one file, or
    with ``all_columns`` of all files together, for which every footer is read. Unreadable
    files fail the job unless ``skip_corrupt`` is set.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    reader = reader.option("mergeSchema", str(all_columns and schema is None).lower())
    if base_path:
        reader = reader.option("basePath", base_path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_folder(spark: SparkSession, uri: str) -> bool:
    """Deletes a folder given as it stands in ``_metadata.file_path`` (an encoded URI)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder given by its plain path; False if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def date_of_name(name: Column | str) -> Column:
    """Date in a file or folder name: …_YYYYMMDD.parquet, or …_YYYYMM_consolidated (first of month); else null."""
    name = F.col(name) if isinstance(name, str) else name
    daily = F.try_to_timestamp(F.regexp_extract(name, r"_([0-9]{8})\.parquet$", 1), F.lit("yyyyMMdd"))
    month = F.regexp_extract(name, r"_([0-9]{6})_consolidated", 1)
    monthly = F.try_to_timestamp(F.concat(month, F.lit("01")), F.lit("yyyyMMdd"))
    return F.coalesce(daily, monthly).cast("date")


def with_file_date(df: DataFrame, out: str = "file_date") -> DataFrame:
    """Adds the date in each row's file name; rows of files without one are left out.

    The folder above counts too, as Spark writes a dataset as a folder of part files.
    """
    file = F.element_at(F.split("_metadata.file_path", "/"), -1)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return df.withColumn(out, F.coalesce(date_of_name(file), date_of_name(folder))).where(F.col(out).isNotNull())


def count_from_file(df: DataFrame, name_part: str) -> DataFrame:
    """Rows whose source file name holds a part."""
    return df.where(F.contains(F.col("_metadata.file_path"), F.lit(name_part))).agg(F.count("*").alias("total_records"))


FILE_LIST = "path string, modificationTime timestamp, length bigint"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length`` of the data files below a folder, hidden ones left out; contents are not read.

    A missing or empty folder gives no rows.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], FILE_LIST)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(path)
    # The path as every scan names it (an encoded URI), so that rows can be told by their file.
    return files.select(F.col("_metadata.file_path").alias("path"), "modificationTime", "length")


def newest_files(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The n files changed last, with time and size; contents are not read."""
    return list_files(spark, path).orderBy(F.desc("modificationTime"), F.desc("path")).limit(n)


def folder_value(path: Column, name: str) -> Column:
    """The whole number that stands in a path's folder ``name=``; null if there is none."""
    return F.regexp_extract(path, f"/{name}=0*([0-9]+)/", 1).try_cast("int")


def read_files(
    spark: SparkSession, files: Sequence[str], base_path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Scan of exactly these files of a partitioned dataset, given as they stand in a listing; files that come later are not seen."""
    names = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString() for f in files]
    return read_dataset(spark, names, schema, base_path, all_columns=True)


def _footer_errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads each footer on its own; a file whose footer can be read only has no rows and is not returned."""
    import pyarrow.parquet as pq

    for batch in batches:
        found = []
        for path, tail in zip(batch["path"], batch["tail"]):
            try:
                pq.read_metadata(io.BytesIO(b"PAR1" + bytes(tail)))
            except Exception as e:  # noqa: BLE001 - whatever the reader says is the finding
                found.append((path, f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"))
        yield pd.DataFrame(found, columns=["path", "error"])


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, error`` of the Parquet files below a folder whose footer cannot be read.

    One distributed scan of the footers alone counts the rows of each file and passes over bad files. Only files that
    gave no row are then looked into: their footer is cut from the content and parsed, so that a sound file without
    rows is not reported. Their paths pass through the driver. Damage behind a sound footer is not found here and
    fails a later scan. Files of zero bytes are in no listing and no scan of Spark's, so neither here. A missing or
    empty folder gives no rows.
    """
    files = list_files(spark, path)
    if not path_exists(spark, path):
        return files.select("path", F.lit("").alias("error"))
    no_columns = T.StructType([T.StructField("_", T.ByteType())])
    footers = spark.read.schema(no_columns).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    with_rows = footers.option("pathGlobFilter", "[!_.]*").parquet(path).select(F.col("_metadata.file_path").alias("path")).distinct()
    odd = [r[0] for r in files.join(with_rows, "path", "left_anti").select("path").toLocalIterator()]
    if not odd:
        return files.limit(0).select("path", F.lit("").alias("error"))
    names = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString() for f in odd]
    content = spark.read.format("binaryFile").load(names).select(F.col("_metadata.file_path").alias("path"), "content", "length")
    # The last eight bytes are the footer's size (little-endian) and the mark PAR1.
    swapped = F.concat(*[F.substring(F.hex(F.substring("content", -8, 4)), i, 2) for i in (7, 5, 3, 1)])
    size = F.conv(swapped, 16, 10).cast("long") + 8
    framed = (F.col("length") >= 12) & (F.substring("content", -4, 4) == F.lit(b"PAR1")) & (size + 4 <= F.col("length"))
    parted = content.select(
        "path", F.when(~framed, "no footer at the end of the file").alias("error"),
        F.when(framed, F.substring("content", -size.cast("int"), size.cast("int"))).alias("tail"))
    parsed = parted.where(F.col("error").isNull()).select("path", "tail").mapInPandas(_footer_errors, "path string, error string")
    return parted.where(F.col("error").isNotNull()).select("path", "error").unionByName(parsed)


def read_sound_files(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of the readable files of a partitioned dataset, and the files left out with their errors.

    Without bad files this is the plain scan of the folder. With some it is a scan of the other files, one path a
    file through the driver; it still fails on damage behind a sound footer instead of losing rows.
    """
    bad = unreadable_files(spark, path)
    skipped = [tuple(r) for r in bad.toLocalIterator()]
    log = spark.createDataFrame(skipped, "path string, error string")
    if not skipped:
        return read_dataset(spark, path, schema, all_columns=True), log
    good = list_files(spark, path).join(log, "path", "left_anti").select("path")
    files = [r[0] for r in good.toLocalIterator()]
    if not files:
        if schema is None:
            raise ValueError(f"no readable file below {path}, and no schema is given")
        return spark.createDataFrame([], schema), log
    return read_files(spark, files, path, schema), log


def delete_files(spark: SparkSession, files: Sequence[str]) -> int:
    """Deletes files given as they stand in a listing, and folders that are empty without them; returns the number of files that were there."""
    gone = 0
    for f in files:
        p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f))
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        gone += fs.delete(p, False)
        while "=" in p.getParent().getName():
            p = p.getParent()
            try:  # a folder that holds anything, also a file that has come just now, is not deleted
                fs.delete(p, False)
            except Py4JJavaError:
                break
    return gone


def write_text_file(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file under a new name in one step: readers see it whole or not at all. False if the name is taken."""
    final = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{final.getParent()}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        return False
    return True


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in one folder, hidden ones left out; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def with_control_columns(df: DataFrame, run_ts: Column, day: Column | str) -> DataFrame:
    """Adds the run's clock and the publication date as ISO text."""
    day = F.col(day) if isinstance(day, str) else day
    return df.withColumns({
        V.EXTRACTION_DATE: F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        V.PUBLICATION_DATE: F.date_format(day, "yyyy-MM-dd"),
    })


def _write_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    # The rebalance step gathers a partition's rows into few files and splits a large one.
    (
        df.hint("rebalance", *[F.col(c) for c in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str, day: str) -> None:
    """Writes rows under year=/month=/day=; a day in the input replaces that day, no input changes nothing."""
    _write_partitions(df.withColumns(partition_columns(day)), path, DAY_PARTITIONS)


def write_monthly(df: DataFrame, path: str, day: str | None = None) -> None:
    """Writes rows under year=/month=, replacing the months in the input."""
    if day is not None:
        parts = partition_columns(day)
        df = df.withColumns({"year": parts["year"], "month": parts["month"]})
    _write_partitions(df, path, MONTH_PARTITIONS)


def _declare_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: Sequence[str]) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{p}`" for p in partitions)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({parts}) LOCATION '{location}'")


def create_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: Sequence[str] = MONTH_PARTITIONS
) -> None:
    """A catalog table over a partitioned dataset, with its partitions found by listing; see :func:`create_projected_table`."""
    _declare_table(spark, name, path, schema, partitions)
    spark.catalog.recoverPartitions(name)


def create_projected_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, first: date, last: date,
    partitions: Sequence[str] = MONTH_PARTITIONS, folder: str | None = None, at_once: int = 200,
) -> int:
    """A catalog table whose partitions are declared by a range of dates; no folder is listed to find them.

    ``partitions`` are (year, month) or (year, month, day). ``folder`` is the place of one below ``path``, by default
    ``year={year}/month={month}`` and so on; ``{month:02d}`` gives padded names. A query lists only the folders that
    its filter on the partitions leaves. A declared folder without files has no rows, and folders outside the range
    are not seen. May be run again, also with a later ``last``, to declare what is new. Returns the number of partitions.
    """
    if tuple(partitions) not in (MONTH_PARTITIONS, DAY_PARTITIONS):
        raise ValueError(f"partitions by date are {MONTH_PARTITIONS} or {DAY_PARTITIONS}")
    folder = folder or "/".join(f"{p}={{{p}}}" for p in partitions)
    days = (first + timedelta(n) for n in range((last - first).days + 1))
    keys = list(dict.fromkeys(tuple(getattr(d, p) for p in partitions) for d in days))
    _declare_table(spark, name, path, schema, partitions)
    for at in range(0, len(keys), at_once):
        clauses = []
        for key in keys[at:at + at_once]:
            values = dict(zip(partitions, key))
            place = f"{path}/{folder.format(**values)}".replace("'", "\\'")
            clauses.append(f"PARTITION ({', '.join(f'`{p}` = {v}' for p, v in values.items())}) LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(clauses)}")
    return len(keys)


def create_table_as(df: DataFrame, name: str, path: str, partitions: Sequence[str] = ()) -> None:
    """A catalog table of the frame's rows at ``path``."""
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def rewrite_to_schema(
    spark: SparkSession, path: str, schema: T.StructType, backup: str, partitions: Sequence[str] = ()
) -> int:
    """Rewrites a dataset in the given schema and returns its row count.

    The original is first copied to ``backup``, a new path for every rewrite; a finished copy is marked and never
    written again. The rewrite reads the copy, so it may be lost at any point and run again.
    ``partitions`` are the folder columns, which stay folders. Rows, columns and types are checked at the end.
    """
    def put(df: DataFrame, to: str) -> None:
        writer = df.write.mode("overwrite").option("compression", "snappy")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(to)

    if not path_exists(spark, f"{backup}/_SUCCESS"):
        put(spark.read.parquet(path), backup)
    original = spark.read.parquet(backup)
    put(conform(original, schema), path)
    data = T.StructType([f for f in schema.fields if f.name not in partitions])
    expected, written = original.count(), spark.read.parquet(path)
    found = {f.name: f.dataType.simpleString() for f in written.schema.fields}
    if written.count() != expected or any(found.get(f.name) != f.dataType.simpleString() for f in data.fields):
        raise RuntimeError(f"rewrite of {path} is incomplete; the original is at {backup}")
    return expected
