"""Ratios with a defined value for an empty denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """part / whole in percent, 0 where the whole is 0."""
    return F.round(F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0)), places)


def per_item(total: Column, items: Column, places: int) -> Column:
    """total over at least one item."""
    return F.round(F.coalesce(total, F.lit(0)) / F.greatest(items, F.lit(1)), places)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
