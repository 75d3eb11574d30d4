"""Look-ups in domain tables.

No join here carries a broadcast hint: Spark broadcasts a side whose size it knows to be
under ``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution re-checks it at run
time) and shuffles, with skew splitting, otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col


def lookup(
    df: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, str], dim_key: str = "code", found: str | None = None
) -> DataFrame:
    """Left look-up of ``columns`` (dim name to output name); ``key`` may reach into a struct.

    A code that the dim repeats counts once, with the least of its rows, so no row is
    multiplied. Rows without a partner keep null; ``found`` names a column that tells them from a
    known code without a value.
    """
    values = F.struct(*[F.col(src).alias(f"_out_{out}") for src, out in columns.items()])
    right = dim.groupBy(F.col(dim_key).alias("_dim_key")).agg(F.min(values).alias("_v")).select("_dim_key", "_v.*")
    joined = df.join(right, F.col(key) == F.col("_dim_key"), "left")
    added = {out: F.col(f"_out_{out}") for out in columns.values()}
    if found:
        added[found] = F.col("_dim_key").isNotNull()
    return joined.withColumns(added).drop("_dim_key", *[f"_out_{out}" for out in columns.values()])


def _labelled(key: str, out: str, fallback: str) -> Column:
    """The found value; the fallback with the code for an unknown code; null for a null code."""
    code = F.col(key)
    return F.when(F.col("_found"), F.col(out)).when(code.isNotNull(), F.format_string(fallback, code.cast("string")))


def enrich(
    df: DataFrame, dim: DataFrame, key: str, out: str, fallback: str, name: str = "name", dim_key: str = "code"
) -> DataFrame:
    """Name of a code; an unknown code gets the labelled fallback, a null code null."""
    joined = lookup(df, dim, key, {name: out}, dim_key, found="_found")
    return joined.withColumn(out, _labelled(key, out, fallback)).drop("_found")


def enrich_all(df: DataFrame, dims: Mapping[str, DataFrame], plan: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """Every look-up of ``plan`` (table, its column, key, output, fallback) whose table is given and whose key exists.

    Look-ups in one table by one key share a join.
    """
    joins: dict[tuple[str, str], dict[str, tuple[str, str]]] = {}
    for name, column, key, out, fallback in plan:
        if name in dims and column in dims[name].columns and key.split(".")[0] in df.columns:
            joins.setdefault((name, key), {})[column] = (out, fallback)
    for (name, key), columns in joins.items():
        df = lookup(df, dims[name], key, {column: out for column, (out, _) in columns.items()}, found="_found")
        df = df.withColumns({out: _labelled(key, out, fallback) for out, fallback in columns.values()}).drop("_found")
    return df


def domain_table(df: DataFrame, code: str, name: str, description: str | None = None, active: str | None = None) -> DataFrame:
    """A table in the shape look-ups expect: code, name, description, active."""
    return df.select(
        F.col(code).alias("code"),
        F.col(name).alias("name"),
        (F.col(description) if description else F.lit(None).cast("string")).alias("description"),
        (F.col(active) if active else F.lit(True)).alias("active"),
    )


def active_codes(dim: DataFrame) -> DataFrame:
    return dim.where("active").select("code")


def with_valid_code(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose code exists and is active."""
    return df.join(active_codes(dim), F.col(key) == F.col("code"), "left_semi")


def in_codes(c: Column | str, codes: Sequence) -> Column:
    return F.coalesce(as_col(c).isin(list(codes)), F.lit(False))


def family_of(c: Column | str, families: Mapping[str, Sequence]) -> Column:
    """Family of a code; the families are a small constant, so this is a projection and no join."""
    label = F.lit(None).cast("string")
    for name, codes in families.items():
        label = F.when(as_col(c).isin(list(codes)), F.lit(name)).otherwise(label)
    return label


def family_table(families: DataFrame, family: str = "family", codes: str = "codes") -> DataFrame:
    """family to list of codes, as one row per code."""
    return families.select(F.col(family).alias("family"), F.explode(codes).alias("code"))
