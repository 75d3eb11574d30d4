"""Parsing of a model's verdict text and its repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import as_col, contains_any, strip


def _values(lines: Column, marks: Sequence[str]) -> Column:
    """Stripped rest of every line that starts with one of the marks."""
    def rest(line: Column) -> Column:
        for mark in marks:
            line = F.replace(line, F.lit(mark), F.lit(""))
        return strip(line)

    def starts(line: Column) -> Column:
        test = F.lit(False)
        for mark in marks:
            test = test | F.startswith(line, F.lit(mark))
        return test

    return F.transform(F.filter(lines, starts), rest)


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def verdict_lines(text: Column | str) -> Column:
    return F.transform(F.split(F.coalesce(as_col(text), F.lit("")), "\n"), lambda line: strip(line))


def parse_verdict(lines: Column | str) -> dict[str, Column]:
    """decisao, categoria, confianca and justificativa out of the lines of a verdict.

    The last line of a kind counts; an unknown decision leaves the one before; a
    confidence that is no whole number is 0; without a line the verdict is a reject.
    """
    lines = as_col(lines)
    decisions = F.filter(
        F.transform(_values(lines, V.DECISION_MARKS), lambda d: F.upper(d)),
        lambda d: d.isin(V.APPROVE, V.REJECT))
    number = _last(F.transform(
        _values(lines, V.CONFIDENCE_MARKS), lambda t: strip(F.replace(t, F.lit("%"), F.lit("")))))
    whole = F.when(F.rlike(number, F.lit(r"^[+-]?[0-9]+(_[0-9]+)*\z")), F.replace(number, F.lit("_"), F.lit("")))
    return {
        "decisao": F.coalesce(_last(decisions), F.lit(V.REJECT)),
        "categoria": F.coalesce(_last(_values(lines, [V.CATEGORY_MARK])), F.lit("")),
        "confianca": F.coalesce(whole.try_cast("bigint"), F.lit(0).cast("bigint")),
        "justificativa": F.coalesce(_last(_values(lines, [V.JUSTIFICATION_MARK])), F.lit("")),
    }


def needs_repair(decision: Column | str, confidence: Column | str, justification: Column | str) -> Column:
    """A reject without confidence whose reason speaks of approval (its negation too)."""
    return (
        (as_col(decision) == V.REJECT)
        & (as_col(confidence) == 0)
        & contains_any(F.lower(as_col(justification)), V.REPAIR_PHRASES)
    )


def repair_verdict(decision: Column | str, confidence: Column | str, justification: Column | str) -> dict[str, Column]:
    hit = needs_repair(decision, confidence, justification)
    return {
        "decisao": F.when(hit, F.lit(V.APPROVE)).otherwise(as_col(decision)),
        "confianca": F.when(hit, F.lit(V.REPAIR_CONFIDENCE).cast("bigint")).otherwise(as_col(confidence)),
    }
