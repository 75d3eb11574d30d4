"""Text columns: folding, whole words, substring and pattern tests, previews, keys."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One word character: letters, digits and other numbers, underscore.
WORD_CHAR = r"[\p{L}\p{N}_]"


@lru_cache(maxsize=1)
def _white_space() -> str:
    """Every white-space character, as it is stripped from both ends of a text."""
    return "".join(chr(code) for code in range(sys.maxunicode + 1) if chr(code).isspace())


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def _fold_map() -> tuple[str, str]:
    """Characters whose accent-free form is one character, and marks to drop, as translate() wants them."""
    source, target, dropped = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        ch = chr(code)
        plain = "".join(p for p in unicodedata.normalize("NFD", ch) if unicodedata.category(p) != "Mn")
        if plain == ch or len(plain) > 1:
            continue
        if plain:
            source.append(ch)
            target.append(plain)
        else:
            dropped.append(ch)
    return "".join(source) + "".join(dropped), "".join(target)


def fold_text(c: Column | str) -> Column:
    """Text without accents and in lower case; null becomes the empty text.

    A text of ASCII characters only has as many bytes as characters and skips the
    character map. Hangul syllables and a few Indic vowels, whose decomposition is
    more than one base character, stay composed; see :func:`fold_text_exact`.
    """
    c = as_col(c)
    source, target = _fold_map()
    plain = F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(c, source, target))
    return F.coalesce(F.lower(plain), F.lit(""))


PAGE = 256  # code points in a page of the table of long forms


@lru_cache(maxsize=1)
def _long_folds() -> dict[int, str]:
    """Code points whose accent-free form is several characters, Hangul syllables among them, with that form."""
    found = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        plain = "".join(p for p in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(p) != "Mn")
        if len(plain) > 1:
            found[code] = plain
    return found


@lru_cache(maxsize=1)
def _long_pages() -> str:
    """The long forms by page and place in it, as JSON; a page without any is null."""
    folds = _long_folds()
    held = {code // PAGE for code in folds}
    return json.dumps([
        [folds.get(page * PAGE + i) for i in range(PAGE)] if page in held else None for page in range(max(held) + 1)])


@lru_cache(maxsize=1)
def _long_class() -> str:
    """A character class of all that have a long form, by ranges."""
    out = ""
    for _, run in groupby(enumerate(sorted(_long_folds())), lambda x: x[1] - x[0]):
        codes = [code for _, code in run]
        out += chr(codes[0]) if len(codes) == 1 else f"{chr(codes[0])}-{chr(codes[-1])}"
    return f"[{out}]"


def fold_text_exact(c: Column | str) -> Column:
    """As :func:`fold_text` with Hangul and every other character fully decomposed, in column expressions.

    Only texts with such characters pay for it: their long forms are found by two array look-ups a character, in a table
    that is a constant of the plan. Spark's lower case may know other case pairs than Python's, by the
    Unicode version of each. Two spacing marks in a row that a normal form would swap stay as they stand.
    """
    pages = F.from_json(F.lit(_long_pages()), T.ArrayType(T.ArrayType(T.StringType())))

    def long_form(ch: Column) -> Column:
        code = F.ascii(ch)
        found = F.get(F.get(pages, F.shiftright(code, 8)), code.bitwiseAND(PAGE - 1))
        return F.when(ch < chr(min(_long_folds())), ch).otherwise(F.coalesce(found, ch))

    def parted(t: Column) -> Column:
        has_long = (F.octet_length(t) != F.char_length(t)) & F.rlike(t, F.lit(_long_class()))
        return F.when(has_long, F.array_join(F.transform(F.split(t, ""), long_form), "")).otherwise(t)

    # Each step names its text several times, so it is bound as a lambda variable and made once.
    return F.element_at(F.transform(F.transform(F.array(as_col(c)), parted), fold_text), 1)


@F.pandas_udf(T.StringType())
def _fold_series(s: pd.Series) -> pd.Series:
    s = s.fillna("").str.normalize("NFD")
    marks = s.map(lambda t: not t.isascii())
    s[marks] = s[marks].map(lambda t: "".join(ch for ch in t if unicodedata.category(ch) != "Mn"))
    return s.str.lower()


def fold_text_full(c: Column | str) -> Column:
    """As :func:`fold_text` with full decomposition of every script; goes through Arrow batches."""
    return _fold_series(as_col(c))


def words(folded: Column | str) -> Column:
    """The runs of word characters of a text, in order; texts of ASCII characters take the cheaper class."""
    c = as_col(folded)
    ascii_runs = F.regexp_extract_all(c, F.lit(r"\w+"), F.lit(0))
    all_runs = F.regexp_extract_all(c, F.lit(WORD_CHAR + "+"), F.lit(0))
    return F.when(F.octet_length(c) == F.char_length(c), ascii_runs).otherwise(all_runs)


def gaps(folded: Column | str) -> Column:
    """The runs of other characters that stand between two words of a text."""
    other = WORD_CHAR.replace("[", "[^", 1)
    return F.regexp_extract_all(as_col(folded), F.lit(f"(?<={WORD_CHAR}){other}+(?={WORD_CHAR})"), F.lit(0))


def word_pattern(term: Column | str) -> Column:
    """Pattern that finds a literal term with a word boundary at both ends.

    A boundary beside a word character needs a non-word neighbour and the other way round.
    """
    term = as_col(term)
    quoted = F.concat(F.lit(r"\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    left = F.when(F.rlike(term, F.lit("^" + WORD_CHAR)), F.lit(f"(?<!{WORD_CHAR})")).otherwise(F.lit(f"(?<={WORD_CHAR})"))
    right = F.when(F.rlike(term, F.lit(WORD_CHAR + r"\z")), F.lit(f"(?!{WORD_CHAR})")).otherwise(F.lit(f"(?={WORD_CHAR})"))
    return F.concat(left, quoted, right)


def has_word(folded: Column | str, folded_term: Column | str) -> Column:
    """True where the term stands in the text as a whole word; false for an empty text or term.

    ``folded_term`` is a Column or, as a plain string, the term itself.
    """
    folded = as_col(folded)
    term = F.lit(folded_term) if isinstance(folded_term, str) else folded_term
    usable = (F.coalesce(folded, F.lit("")) != "") & (F.coalesce(term, F.lit("")) != "")
    return F.coalesce(usable & F.rlike(folded, word_pattern(term)), F.lit(False))


def is_empty_text(c: Column | str) -> Column:
    """Null or zero characters; blanks are text."""
    return F.coalesce(as_col(c), F.lit("")) == ""


def strip(c: Column | str) -> Column:
    """White space of every kind removed from both ends."""
    return F.btrim(as_col(c), F.lit(_white_space()))


def text_key(c: Column | str) -> Column:
    """md5 of the lower-cased, stripped text: the key of a stored verdict. Null counts as empty.

    The key is never null, so a join on it adds no null test that would hash the text twice.
    """
    return F.md5(strip(F.lower(F.coalesce(as_col(c), F.lit("")))).cast("binary"))


def preview(c: Column | str, n: int) -> Column:
    """The first n characters and three dots where the text is longer, else the text."""
    c = as_col(c)
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def _any_part(t: Column, needles: Sequence[str]) -> Column:
    test = F.lit(False)
    for needle in needles:
        test = test | F.contains(t, F.lit(needle))
    return test


def contains_any(c: Column | str, needles: Sequence[str]) -> Column:
    """True where any of the literal parts occurs (case and accents as given).

    The text is bound once as a lambda variable, so a derived text (lower(c)) is computed
    once per row and not once per part.
    """
    return F.coalesce(F.exists(F.array(as_col(c)), lambda t: _any_part(t, needles)), F.lit(False))


def contains_any_lower(c: Column | str, needles: Sequence[str]) -> Column:
    """True where the lower-cased text holds any part; accents are not folded."""
    return contains_any(F.lower(as_col(c)), needles)


def matches_any(c: Column | str, alternatives: Sequence[str]) -> Column:
    """True where the lower-cased text holds any of the regular expressions."""
    return F.coalesce(F.rlike(F.lower(as_col(c)), F.lit("|".join(alternatives))), F.lit(False))


def classify_text(c: Column | str, classes: Sequence[tuple[str, Sequence[str]]], other: str) -> Column:
    """Label of the first class with a part in the upper-cased text, else ``other``."""
    def label(t: Column) -> Column:
        out = F.lit(other)
        for name, parts in reversed(list(classes)):
            out = F.when(_any_part(t, parts), F.lit(name)).otherwise(out)
        return out

    # As in contains_any, the upper-cased text is bound once.
    return F.element_at(F.transform(F.array(F.upper(as_col(c))), label), 1)


def yes_no(c: Column | str, yes: str, no: str) -> Column:
    """Label of a boolean; null counts as false."""
    return F.when(as_col(c), F.lit(yes)).otherwise(F.lit(no))


def glob_parse(c: Column | str, glob: str, fields: Sequence[str], numeric: Sequence[str] = ()) -> list[Column]:
    """One column per ``*`` of the pattern, null where the pattern does not occur.

    A field named in ``numeric`` takes a number only, so punctuation after it stays out.
    """
    c = as_col(c)
    parts = glob.split("*")
    if len(parts) - 1 != len(fields):
        raise ValueError(f"{len(fields)} field names for {len(parts) - 1} stars")
    pattern = re.escape(parts[0])
    for i, name in enumerate(fields):
        tail = parts[i + 1]
        pattern += r"(-?[0-9]+(?:\.[0-9]+)?)" if name in numeric else ("(.*?)" if tail else "(.*)")
        pattern += re.escape(tail)
    found = F.rlike(c, F.lit(pattern))
    out = []
    for i, name in enumerate(fields):
        value = F.when(found, F.regexp_extract(c, pattern, i + 1))
        out.append((value.cast("double") if name in numeric else value).alias(name))
    return out
