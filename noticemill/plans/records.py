"""From raw records to kept, enriched, normalised records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.nested import fill_record
from ..operators.enrich import enrich_all
from ..schemas import RECORD_ARRAYS, RECORD_STRUCTS
from ..session import MAX_INLINE_ENTRIES
from .hybrid import hybrid_filter

_MARKS = ["included", "reason", "details", "matched_group", "matched_term", "stage1_passed", "stage2_passed", "text_empty"]


def filter_columns(df: DataFrame) -> DataFrame:
    """The five filter columns of a kept row out of the filter's marks; an absent detail is the empty text."""
    names = V.FILTER_COLUMNS
    return df.withColumns({
        names["applied"]: F.lit(True),
        names["reason"]: F.col("reason"),
        names["group"]: F.coalesce("details.grupo_matched", F.lit("")),
        names["term"]: F.coalesce("details.termo_matched", F.lit("")),
        names["criterion"]: F.coalesce("details.criterio", F.lit("")),
    }).drop(*_MARKS)


def finish_records(
    kept: DataFrame,
    dims: Mapping[str, DataFrame],
    lookups: Sequence[tuple[str, str, str, str, str]] = tuple(V.DOMAIN_LOOKUPS),
    structs: Mapping[str, T.StructType] = RECORD_STRUCTS,
    arrays: Mapping[str, T.StructType] = RECORD_ARRAYS,
) -> DataFrame:
    """Filter columns, look-ups and nested fill of rows that ``hybrid_filter`` has kept."""
    return fill_record(enrich_all(filter_columns(kept), dims, lookups), structs, arrays)


def record_pipeline(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    dims: Mapping[str, DataFrame],
    verdicts: DataFrame | None = None,
    lookups: Sequence[tuple[str, str, str, str, str]] = tuple(V.DOMAIN_LOOKUPS),
    structs: Mapping[str, T.StructType] = RECORD_STRUCTS,
    arrays: Mapping[str, T.StructType] = RECORD_ARRAYS,
    on_missing: str = "reject",
    enabled: bool = True,
    id_col: str | None = None,
    inline_bound: int = MAX_INLINE_ENTRIES,
) -> DataFrame:
    """Filter, filter columns, look-ups and nested fill, in one plan over any number of days.

    With ``enabled=False`` every row is kept, with the bypass as its reason and empty details.
    """
    kept = hybrid_filter(df, text, lexicon, verdicts, on_missing, enabled, True, id_col, inline_bound)
    return finish_records(kept, dims, lookups, structs, arrays)
