"""Nested columns: fill, merge and conform structs and arrays of structs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import as_col


def try_to(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value in the wanted type at every depth; whatever cannot be cast, at its own place, is null.

    Structs take the wanted fields by name, an absent one is null; arrays and maps go element by element. A struct,
    array or map where another kind is wanted is null.
    """
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        parts = [
            (try_to(value.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda e: try_to(e, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType) and have.keyType == want.keyType:
        return F.transform_values(value, lambda _, v: try_to(v, have.valueType, want.valueType))
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in (have, want)):
        return F.lit(None).cast(want)
    return value.try_cast(want)


def _filled(value: Column, have: T.DataType | None, want: T.StructType) -> Column:
    """A struct that is never null: own fields of ``value``, wanted fields it lacks or cannot hold as null.

    A field of a null struct reads as null, so no test of the struct itself is needed.
    """
    known = {f.name: f.dataType for f in have.fields} if isinstance(have, T.StructType) else {}
    parts = []
    for f in want.fields:
        part = try_to(value.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)
        parts.append(part.alias(f.name))
    parts += [value.getField(n).alias(n) for n in known if n not in want.fieldNames()]
    return F.struct(*parts)


def fill_struct(df: DataFrame, column: str, want: T.StructType) -> DataFrame:
    """The column as a struct with every wanted field; missing or null becomes a struct of nulls."""
    have = df.schema[column].dataType if column in df.columns else None
    return df.withColumn(column, _filled(F.col(column) if have else F.lit(None), have, want))


def fill_struct_array(df: DataFrame, column: str, want: T.StructType) -> DataFrame:
    """The column as an array of filled structs; missing or null becomes an empty array."""
    have = df.schema[column].dataType if column in df.columns else None
    if not isinstance(have, T.ArrayType):
        return df.withColumn(column, F.array().cast(T.ArrayType(want)))
    filled = F.transform(F.col(column), lambda e: _filled(e, have.elementType, want))
    return df.withColumn(column, F.coalesce(filled, F.array().cast(T.ArrayType(want))))


def fill_record(
    df: DataFrame, structs: Mapping[str, T.StructType], arrays: Mapping[str, T.StructType]
) -> DataFrame:
    """All nested columns of a record filled, in one projection each."""
    for column, want in structs.items():
        df = fill_struct(df, column, want)
    for column, want in arrays.items():
        df = fill_struct_array(df, column, want)
    return df


def merge_defaults(value: Column | str, have: T.StructType, defaults: Mapping[str, object]) -> Column:
    """Defaults overlaid by the struct: its fields win even when null; a null struct gives the defaults."""
    value = as_col(value)
    parts = []
    for name, default in defaults.items():
        if name in have.fieldNames():
            kind = have[name].dataType
            parts.append(
                F.when(value.isNull(), F.lit(default).cast(kind)).otherwise(value.getField(name)).alias(name))
        else:
            parts.append(F.lit(default).alias(name))
    parts += [value.getField(n).alias(n) for n in have.fieldNames() if n not in defaults]
    return F.struct(*parts)


def merge_right(left: Mapping[str, Column], right: Mapping[str, Column]) -> Column:
    """One struct of two sets of details; on a shared name a non-null right value wins."""
    parts = []
    for name in [*left, *[n for n in right if n not in left]]:
        both = [side[name] for side in (right, left) if name in side]
        parts.append(F.coalesce(*both).alias(name))
    return F.struct(*parts)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in the given schema: columns added, dropped, reordered and cast, at every depth.

    A value or nested value that cannot be cast becomes null, and so does a column of another kind than the
    wanted one (a nested column written as all null).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (try_to(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
