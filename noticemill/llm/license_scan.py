"""License notices by diagonal voting: rolling word k-grams joined to template positions.

Every k-gram of a text that also stands in a template votes for the diagonal on which the two line up
(its place in the text less its place in the template). Votes are added up by diagonal, neighbouring diagonals of one template are merged, as a
word more or less shifts the rest of a notice by one, and a merged span counts as found if the words that were
compared there cover enough of the template. A hash only proposes: a vote needs equal words.

All steps are DataFrame functions. The one table that is broadcast is that of the templates' k-grams; its size is checked.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ASCII but letters and digits, one by one: a class of single characters is a table look-up for the regex engine, ranges are not.
BETWEEN_WORDS = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
KELVIN = "\u212a"  # the one character that is not ASCII but has an ASCII letter for its lower case
WIDTH = 2  # words of a gram: the shortest phrases have two
MAX_BROADCAST_GRAMS = 100_000


@dataclass(frozen=True)
class Template:
    """A notice: its label and words, how far merged diagonals may be apart, and the share of its words to be found."""

    label: str
    text: str
    gap: int = 3
    cover: float = 0.75
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w.translate(str.maketrans(UPPER, LOWER)) for w in re.split(BETWEEN_WORDS, self.text) if w]


def phrase(label: str, text: str, base: bool = False) -> Template:
    """Found only whole, word by word, on one diagonal."""
    return Template(label, text, gap=0, cover=1.0, base=base)


# The phrases of the base labels.
BASE = (
    phrase("mit", "mit license", base=True),
    phrase("apache", "apache license", base=True),
    phrase("gpl", "general public license", base=True),
)
# The public wording of common notices.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files, to deal in the Software without restriction"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    Template("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
             "by the Free Software Foundation"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    phrase("apache-2.0", "apache license version 2 0"),
    phrase("gpl-2.0", "general public license version 2"),
    phrase("gpl-3.0", "general public license version 3"),
    phrase("cc-by", "licensed under cc by"),
    phrase("cc-by", "creative commons attribution"),
    phrase("cc-by-nc", "licensed under cc by nc"),
    phrase("cc-by-nc", "creative commons attribution noncommercial"),
    phrase("cc-by-sa", "licensed under cc by sa"),
    phrase("cc-by-sa", "creative commons attribution sharealike"),
    phrase("cc-by-nd", "licensed under cc by nd"),
    phrase("cc0", "cc0 1 0 universal"),
    phrase("bsd", "bsd license"),
    phrase("proprietary", "all rights reserved"),
)


def words_of(text: Column) -> Column:
    """The runs of letters, digits and all that is not ASCII, in lower case.

    Beyond A-Z lower case is Unicode's, which is faster and here the same: a word of ASCII letters comes of no other letters.
    """
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit(KELVIN), F.lit("\ufffd"))), BETWEEN_WORDS), "")


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``template, place, t_key, t_gram``: every k-gram of every template with the hash it is found by."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(place).alias("place"), F.lit(" ".join(t.words[place: place + WIDTH])).alias("t_gram"))
                     for i, t in enumerate(templates) for place in range(len(t.words) - WIDTH + 1)])
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.*", F.xxhash64("t.t_gram").alias("t_key"))


def scan(docs: DataFrame, templates: Sequence[Template] = BASE + NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, spans, n_base, first_word, last_word, base_labels, labels, score`` per row of ``docs``.

    ``spans`` lists what was found, by start: ``label, start, last`` (its first and last compared word), ``cover`` (share of the
    template's words that stand there, in place up to the merged shifts) and ``base``. ``n_base`` counts the base templates'
    places, ``first_word`` and ``last_word`` are the least and greatest of their starts; labels are distinct, sorted and
    joined by commas; ``score`` is the best cover, 0 without spans. A null or empty text has no words and finds nothing. Rows that repeat
    an id and a text get equal results, one row each; rows of one id with different texts, and null ids, are kept apart by a hash of
    the text. Other columns are left out; an empty table gives no rows.
    """
    if any(len(t.words) < WIDTH or not t.text.isascii() for t in templates):
        raise ValueError(f"a template is ASCII and has at least {WIDTH} words")
    table = template_grams(docs.sparkSession, templates)
    if sum(len(t.words) for t in templates) <= MAX_BROADCAST_GRAMS:
        table = F.broadcast(table)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # An empty word before the first makes a row of its own for each text, whose gram no template has; it carries the number of words
    # past the join. The words themselves must not pass the generator, which would copy them for every gram.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.concat(F.array(F.lit("")), words_of(text)).alias("words"))
    grams = F.transform("words", lambda w, i: F.concat_ws(" ", w, *[F.get("words", i + k) for k in range(1, WIDTH)]))
    placed = rows.select("doc_id", "text_key", (F.size("words") - 1).cast("long").alias("n_words"), F.posexplode(grams).alias("at", "gram"))
    votes = placed.join(table, F.xxhash64("gram") == F.col("t_key"), "left").filter(
        (F.col("at") == 0) | (F.col("template").isNotNull() & (F.col("gram") == F.col("t_gram"))))
    # From here on only votes and one row a text travel, and all of a text's rows meet in one place.
    votes = votes.select("doc_id", "text_key", "n_words", "template", (F.col("at") - 1 - F.col("place")).alias("diagonal"), "place").repartition(
        "doc_id", "text_key")
    text_of = ["doc_id", "text_key"]
    lines = votes.groupBy(*text_of, "template", "diagonal").agg(
        F.max("n_words").alias("n_words"), F.count(F.when(F.col("template").isNull(), F.lit(1))).alias("copies"),
        F.collect_set("place").alias("places"))
    about = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(len(t.words)).alias("size"), F.lit(t.gap).alias("gap"), F.lit(float(t.cover)).alias("cover"), F.lit(t.base).alias("base")) for t in templates])
    described = docs.sparkSession.range(1).select(F.posexplode(about).alias("template", "t")).select(
        F.col("template").alias("number"), "t.label", "t.size", "t.gap", "t.cover", "t.base")
    lines = lines.join(F.broadcast(described), lines["template"] == F.col("number"), "left")
    by_template = Window.partitionBy(*text_of, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_template) > F.col("gap")
    lines = lines.withColumn("apart", F.coalesce(apart, F.lit(True))).withColumn(
        "merged", F.sum(F.col("apart").cast("int")).over(by_template))
    # A template's word is covered if any vote of the merged diagonals compared it; first and last place bound the span.
    compared = F.flatten(F.transform("places", lambda p: F.sequence(p, p + (WIDTH - 1))))
    spans = lines.withColumn("compared", F.when(F.col("template").isNotNull(), compared)).groupBy(
        *text_of, "template", "merged", "label", "size", "cover", "base").agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("compared")))) / F.col("size")).alias("share"),
        F.min(F.array_min("compared") + F.col("diagonal")).alias("start"), F.max(F.array_max("compared") + F.col("diagonal")).alias("last"))
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("last").cast("long").alias("last"), "label",
                    F.col("share").alias("cover"), "base")
    found = spans.groupBy(*text_of).agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
        F.array_sort(F.collect_list(F.when(F.col("share") >= F.col("cover"), span))).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])

    def joined(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    out = found.select(
        "doc_id", "n_words", "spans", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"), "copies")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("_copy", "copies")
