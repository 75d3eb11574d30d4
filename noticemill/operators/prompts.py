"""Prompt columns from templates.

A template is text with named slots: {text}, {group}, {term}, {examples}, {categories},
{category}, {items}. Slots are filled as columns, so a prompt is a plain projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col

_SLOT = re.compile(r"\{([a-z_]+)\}")


def fill_template(template: str, slots: Mapping[str, Column]) -> Column:
    """The template with each slot replaced by its column; a null column is the empty text."""
    parts, at = [], 0
    for m in _SLOT.finditer(template):
        if m.group(1) not in slots:
            raise ValueError(f"no column for slot {m.group(1)}")
        parts += [F.lit(template[at:m.start()]), F.coalesce(slots[m.group(1)].cast("string"), F.lit(""))]
        at = m.end()
    parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def context_prompt(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    context_template: str,
    generic_template: str,
    no_examples: str,
    group: str = "matched_group",
    term: str = "matched_term",
    out: str = "prompt",
) -> DataFrame:
    """Prompt about the matched group with its terms as examples, else the generic prompt.

    A group that is not in the lexicon counts as no group; one without terms gets the
    stock phrase ``no_examples``.
    """
    examples = lexicon.select(
        F.col("group").alias("_group"),
        F.when(F.size("terms") > 0, F.array_join("terms", ", ")).otherwise(F.lit(no_examples)).alias("_examples"),
    )
    slots = {"text": as_col(text), "group": F.col(group), "term": F.col(term), "examples": F.col("_examples")}
    focused = fill_template(context_template, slots)
    generic = fill_template(generic_template, {"text": as_col(text)})
    return (
        df.join(examples, F.col(group) == F.col("_group"), "left")
        .withColumn(out, F.when(F.col("_group").isNotNull(), focused).otherwise(generic))
        .drop("_group", "_examples")
    )


def categorise_prompt(
    df: DataFrame, text: str, categories: str, template: str, context_template: str, out: str = "prompt"
) -> DataFrame:
    """Prompt with a paragraph on the categories found so far, left out where there are none."""
    found = F.array_join(F.coalesce(F.col(categories), F.array().cast("array<string>")), ", ")
    paragraph = F.when(F.size(F.col(categories)) > 0, fill_template(context_template, {"categories": found}))
    return df.withColumn(out, fill_template(template, {"text": as_col(text), "context": paragraph}))


def refine_prompt(df: DataFrame, text: str, category: str, template: str, out: str = "prompt") -> DataFrame:
    """Prompt that asks for a finer category."""
    return df.withColumn(out, fill_template(template, {"text": as_col(text), "category": as_col(category)}))


def plain_prompt(df: DataFrame, text: str, template: str, out: str = "prompt") -> DataFrame:
    """Prompt with the text alone (generic and uncertain cases)."""
    return df.withColumn(out, fill_template(template, {"text": as_col(text)}))


# Keys drawn to place the cuts, on average. It bounds the number of blocks, not the rows.
CUT_KEYS = 1 << 13


def _block_cuts(keys: DataFrame, block_rows: int) -> DataFrame:
    """One row with the sorted keys at which blocks of about ``block_rows`` rows begin, evenly drawn by a hash of the key."""
    rows = keys.agg(F.count(F.lit(1)).alias("n")).scalar()
    step = F.greatest(F.lit(1), F.floor(rows / CUT_KEYS))
    drawn = keys.where(F.col("key").isNotNull()).where(F.pmod(F.xxhash64("key"), step) == 0)
    some = drawn.agg(F.array_sort(F.collect_set("key")).alias("drawn")).withColumn("rows", rows)
    every = F.greatest(F.lit(1), F.floor(F.size("drawn") * F.lit(block_rows) / F.greatest(F.lit(1), F.col("rows"))))
    return some.withColumn("every", every).select(
        F.filter("drawn", lambda _, i: (i > 0) & (F.pmod(i, F.col("every")) == 0)).alias("cuts"))


def row_position(df: DataFrame, key: str, block_rows: int = 100_000, out: str = "position") -> DataFrame:
    """0-based rank of a unique key over the whole frame, without one global sort.

    The key is of any type that can be ordered and hashed. The table's row count gives the number of blocks (at most
    about :data:`CUT_KEYS`), keys drawn evenly by their hash give the cuts between them, and a row finds its block by
    binary search. The cuts are a scalar subquery of the plan: nothing runs before the result is asked for, and
    whichever keys are drawn, the ranks are the same. Running totals over the blocks give each its offset, and rows are
    numbered inside their block. A null key comes first.
    """
    from pyspark.sql.window import Window

    cut = df.withColumn("_cuts", _block_cuts(df.select(F.col(key).alias("key")), block_rows).scalar())
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(CUT_KEYS.bit_length() + 2))])
    passed = F.aggregate(halves, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size("_cuts")) & (F.get("_cuts", at + step - 1) <= F.col(key)), at + step).otherwise(at))
    blocked = cut.withColumn("_block", F.when(F.col(key).isNull(), -1).otherwise(passed)).drop("_cuts")
    before = F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        blocked.groupBy("_block").agg(F.count("*").alias("_n"))
        .select("_block", F.coalesce(before, F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(key)) - 1
    return (
        blocked.withColumn("_inside", inside)
        .join(offsets, "_block")
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_block", "_inside", "_offset")
    )


def batch_prompt(df: DataFrame, key: str, text: str, batch_size: int, template: str, block_rows: int = 100_000) -> DataFrame:
    """One prompt per ``batch_size`` texts in key order, as a numbered list: batch, items, prompt."""
    placed = row_position(df.select(key, text), key, block_rows)
    numbered = placed.select(
        F.floor(F.col("position") / batch_size).alias("batch"),
        F.struct((F.col("position") % batch_size).alias("i"), F.col(text).alias("t")).alias("item"),
    )
    batches = numbered.groupBy("batch").agg(F.array_sort(F.collect_list("item")).alias("item_list"))
    lines = F.transform("item_list", lambda e: F.concat((e["i"] + 1).cast("string"), F.lit(". "), F.coalesce(e["t"], F.lit(""))))
    return batches.select(
        "batch",
        F.size("item_list").cast("bigint").alias("items"),
        fill_template(template, {"items": F.array_join(lines, "\n")}).alias("prompt"),
    )
