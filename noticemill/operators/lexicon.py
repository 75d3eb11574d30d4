"""Keyword lexicon: build, order, and ordered first match over texts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.text import as_col, fold_text, gaps, is_empty_text, preview, word_pattern, words
from ..session import MAX_INLINE_ENTRIES


def build_lexicon(pairs: DataFrame, group: str, term: str) -> DataFrame:
    """Distinct lower-cased pairs as one sorted term list per group: columns group, terms."""
    return (
        pairs.select(F.col(group).alias("group"), F.lower(F.col(term)).alias("term"))
        .groupBy("group")
        .agg(F.array_sort(F.collect_set("term")).alias("terms"))
    )


def explode_lexicon(lexicon: DataFrame) -> DataFrame:
    """(group, terms[, group_pos]) to one row per name or term, with its precedence.

    Longer group names first, then the group's own position (its name where there is
    none); inside a group its name comes before its terms. Precedence is an ordered
    struct, so no global numbering and no single-task window is needed.
    """
    position = F.col("group_pos") if "group_pos" in lexicon.columns else F.lit(0)
    entries = F.concat(F.array(F.col("group")), F.coalesce(F.col("terms"), F.array().cast("array<string>")))
    return lexicon.select(
        F.col("group"), position.cast("bigint").alias("group_pos"), F.posexplode(entries).alias("term_pos", "term")
    ).select(
        "group",
        "term",
        "term_pos",
        "group_pos",
        (F.col("term_pos") == 0).alias("is_group_name"),
        F.struct(
            (-F.char_length("group")).alias("longest"),
            F.col("group_pos").alias("position"),
            F.col("group").alias("name"),
            F.col("term_pos").alias("inner"),
        ).alias("precedence"),
    )


def prepare_entries(lexicon: DataFrame, fold: Callable[[str], Column] = fold_text) -> DataFrame:
    """Lexicon entries with folded form, pattern and anchor.

    The anchor is the longest word of the entry: a text can only hold the entry if that
    word is among its words. An entry without any word character (is_gap) can only stand as
    the whole gap between two words and is its own anchor. An entry that equals its anchor
    is proven by it.
    """
    e = explode_lexicon(lexicon).withColumn("folded", fold("term")).where(F.col("folded") != "")
    longest = F.array_max(
        F.transform(words("folded"), lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]
    return (
        e.withColumn("is_gap", longest.isNull())
        .withColumn("anchor", F.coalesce(longest, F.col("folded")))
        .withColumn("single", F.col("anchor") == F.col("folded"))
        .withColumn("pattern", word_pattern("folded"))
    )


def _anchors_of(folded: str, with_gaps: bool) -> Column:
    """Words of a text and, where the lexicon needs them, the gaps between its words."""
    return F.concat(words(folded), gaps(folded)) if with_gaps else words(folded)


# Up to so many entries an array intersection is the cheapest look-up.
FEW_ENTRIES = 64

_FIELDS = ("precedence", "grp", "term", "single", "folded", "pattern")


def _first_of(df: DataFrame, folded: str, candidates: Column) -> DataFrame:
    """Adds matched_group and matched_term: the candidate of least precedence found as a whole word.

    A single word is proven by its anchor. A phrase is only looked for where it would come
    before the best single word, and by substring before the pattern runs.
    """
    df = df.withColumn("_candidates", candidates).withColumn(
        "_word", F.array_min(F.filter("_candidates", lambda e: e["single"])))
    word, text = F.col("_word"), F.col(folded)

    def better_phrase(e: Column) -> Column:
        before = word.isNull() | (e["precedence"] < word["precedence"])
        return ~e["single"] & before & F.contains(text, e["folded"]) & F.rlike(text, e["pattern"])

    best = F.when(
        F.size("_candidates") > 0, F.coalesce(F.array_min(F.filter("_candidates", better_phrase)), word))
    # One row in, one row out. As a generator's output the match is computed once: a later
    # filter on it is not pushed below and computed a second time.
    return (
        df.withColumn("_best", F.explode_outer(F.array(best)))
        .withColumn("matched_group", F.col("_best.grp"))
        .withColumn("matched_term", F.col("_best.term"))
        .drop("_best", "_word", "_candidates")
    )


def _bucket(word: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets))


def _match_inline(df: DataFrame, folded: str, entries: DataFrame, rows: list) -> DataFrame:
    """First match as a plain projection: no join and no shuffle, one look-up per hit word.

    ``rows`` are the entries of a small lexicon. They become a constant of the plan: an
    array of small maps, addressed by the hash of the word, as a look-up in one large map
    is a scan of its keys.
    """
    kind = T.StructType([
        T.StructField("precedence", T.LongType()), *[entries.schema[f] for f in _FIELDS if f != "precedence"]])
    buckets = max(len(rows), 1)
    index: list[dict] = [{} for _ in range(buckets)]
    for rank, r in enumerate(sorted(rows, key=lambda r: tuple(r["precedence"]))):
        entry = {f: r[f] for f in _FIELDS} | {"precedence": rank}
        index[r["hash"] % buckets].setdefault(r["anchor"], []).append(entry)
    table = F.from_json(
        F.lit(json.dumps(index)), T.ArrayType(T.MapType(T.StringType(), T.ArrayType(kind))))
    anchors = F.from_json(F.lit(json.dumps(sorted({r["anchor"] for r in rows}))), T.ArrayType(T.StringType()))

    in_text = _anchors_of(folded, any(r["is_gap"] for r in rows))
    # An intersection hashes all anchors again for every row, so it only pays for a few of them.
    few = len(rows) <= FEW_ENTRIES
    hits = df.withColumn("_hits", F.array_intersect(in_text, anchors) if few else F.array_distinct(in_text))
    found = F.transform("_hits", lambda w: F.try_element_at(F.get(table, _bucket(w, buckets).cast("int")), w))
    return _first_of(hits, folded, F.flatten(F.filter(found, lambda e: e.isNotNull()))).drop("_hits")


def _rarest_anchors(entries: DataFrame) -> DataFrame:
    """Entries with their two rarest words in the lexicon as anchor and ``second`` (null for a single word or a gap).

    Phrases that share a common word are thus found by another word of theirs, and only where a second one stands.
    """
    spread = entries.select("precedence", F.explode(F.array_distinct(words("folded"))).alias("w"))
    uses = spread.groupBy("w").agg(F.count("*").alias("uses"))
    rarest = spread.join(uses, "w").groupBy("precedence").agg(F.slice(F.array_sort(F.collect_list(
        F.struct("uses", (-F.char_length("w")).alias("longest"), "w"))), 1, 2).alias("rarest"))
    phrase = ~F.col("single") & ~F.col("is_gap")
    return entries.join(rarest, "precedence", "left").withColumns({
        "anchor": F.when(phrase, F.col("rarest")[0]["w"]).otherwise(F.col("anchor")),
        "second": F.when(phrase, F.get("rarest", F.lit(1))["w"]),
    }).drop("rarest")


def _match_joined(df: DataFrame, folded: str, entries: DataFrame, id_col: str | None) -> DataFrame:
    """First match by joining distinct words with anchors, for a lexicon of any size.

    Rows are keyed by ``id_col`` or, without one, by a hash of the folded text, so that equal texts are matched
    once. Texts travel once, in the last join; before it only (key, word) pairs do, and only those of words that the lexicon
    has. A word that many texts share is a skewed key on the text side only, which adaptive execution splits.
    """
    key = "_text_key"
    # The hash is never null, so a join on it adds no null test that would fold and hash the text twice.
    hashed = F.coalesce(F.unhex(F.sha2(F.col(folded).cast("binary"), 256)), F.lit(b""))
    df = df.withColumn(key, F.col(id_col) if id_col else hashed)
    with_gaps = not entries.where("is_gap").isEmpty()
    of_lexicon = entries.select(F.explode(F.concat(F.array("anchor"), words("folded"))).alias("anchor")).distinct()
    in_text = df.select(key, F.explode(F.array_distinct(_anchors_of(folded, with_gaps))).alias("anchor"))
    tokens = in_text.join(of_lexicon, "anchor", "left_semi").select(key, "anchor").distinct()
    found = tokens.join(_rarest_anchors(entries), "anchor")
    both = found.where(F.col("second").isNotNull()).join(
        tokens.select(key, F.col("anchor").alias("second")), [key, "second"], "left_semi")
    found = found.where(F.col("second").isNull()).select(key, *_FIELDS).unionByName(both.select(key, *_FIELDS))
    anchored = found.groupBy(key).agg(F.collect_list(F.struct(*_FIELDS)).alias("_anchored"))
    return _first_of(df.join(anchored, key, "left"), folded, F.col("_anchored")).drop("_anchored", key)


def match_lexicon(
    df: DataFrame, text: str, lexicon: DataFrame, id_col: str | None = None, inline_bound: int = MAX_INLINE_ENTRIES,
    fold: Callable[[str], Column] = fold_text,
) -> DataFrame:
    """Adds matched_group and matched_term: the first lexicon entry, in order of precedence, in the text.

    The lexicon's size is checked: up to ``inline_bound`` entries the match is a projection over the scan, above
    it a join, with the same rows. ``id_col`` may name a unique key for that join; without one it goes by text.
    ``fold`` makes texts and entries comparable; ``fold_text_exact`` takes every script apart.
    """
    entries = prepare_entries(lexicon, fold).withColumnRenamed("group", "grp")
    df = df.withColumn("_folded", fold(text))
    hashed = entries.select(*_FIELDS, "anchor", "is_gap", F.xxhash64("anchor").alias("hash"))
    rows = hashed.limit(inline_bound + 1).collect()
    if len(rows) <= inline_bound:
        return _match_inline(df, "_folded", entries, rows).drop("_folded")
    return _match_joined(df, "_folded", entries, id_col).drop("_folded")


def keyword_stage(
    df: DataFrame, text: str, lexicon: DataFrame, id_col: str | None = None, inline_bound: int = MAX_INLINE_ENTRIES,
    fold: Callable[[str], Column] = fold_text,
) -> DataFrame:
    """First stage of the filter: adds matched_group, matched_term, stage1_passed, stage1_reason, criterion, preview.

    An empty text is rejected with its own reason and no details.
    """
    matched = match_lexicon(df, text, lexicon, id_col, inline_bound, fold)
    group, term = F.col("matched_group"), F.col("matched_term")
    by_name = group == term
    return (
        matched.withColumn("stage1_passed", group.isNotNull())
        .withColumn(
            "stage1_reason",
            F.when(is_empty_text(text), F.lit(V.REASON_EMPTY))
            .when(group.isNull(), F.lit(V.REASON_NO_TERM))
            .when(by_name, F.format_string(V.REASON_GROUP, group))
            .otherwise(F.format_string(V.REASON_TERM, term, group)),
        )
        .withColumn(
            "criterion",
            F.when(by_name, F.format_string(V.CRITERION_GROUP, group))
            .when(group.isNotNull(), F.format_string(V.CRITERION_TERM, term, group)),
        )
        .withColumn("preview", F.when(~is_empty_text(text), preview(as_col(text), 100)))
    )


def hits_per(df: DataFrame, column: str) -> DataFrame:
    """Number of matched rows per group or term."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("hits"))


def top_hits(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n groups or terms with most hits, ties by name."""
    return hits_per(df, column).orderBy(F.desc("hits"), F.asc(column)).limit(n)
