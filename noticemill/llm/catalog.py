"""The queries ``opN_<name>`` over the test tables, and SQL where it can express them.

A query derives the digest columns of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticemill.llm.chat import fold_events, read_back, render
from noticemill.llm.common import id_crc, table
from noticemill.llm.exact_dedup import exact_groups
from noticemill.llm.filter_audit import audit
from noticemill.llm.language_id import identify, learn_profiles
from noticemill.llm.license_scan import BASE, NOTICES, scan
from noticemill.llm.lm_scoring import score_texts
from noticemill.llm.mixing import mix
from noticemill.llm.near_dedup import near_groups
from noticemill.llm.neighbours import nearest
from noticemill.llm.packing import pack_documents
from noticemill.llm.repeats import remove_repeats
from noticemill.llm.runs import periodic_runs
from noticemill.llm.toxicity import learn, score


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), capacity=2048, vocabulary="byte_bpe_50k", end_id=0)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Learned from the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) != 0)
    return learn(docs, labels, max_rows=40_000)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (F.pmod(id_crc(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, F.pmod(id_crc(F.col("doc_id")), F.lit(7)) == 2, order=5)


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=100).drop("kept")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(id_crc(F.col("doc_id")), F.lit(4)) == 2
    found = identify(docs, learn_profiles(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), hash_all=True)


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), width=5, percent=85)


def streamed(rows: DataFrame) -> DataFrame:
    """The log that such conversations leave: a draft, streamed on, replaced by an edit or a new generation, streamed to its end.

    What a message says at last is its row's text, so the fold decides what is read back. Assistants generate again,
    others edit; both have the second half follow as a delta. Rows of one turn are messages of their own.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    replaced = F.when(F.col("role") == "assistant", F.lit("regenerate")).otherwise(F.lit("edit"))
    steps = (
        ("message", F.concat(F.lit("draft: "), F.substr(text, half + 1))), ("delta", F.lit(" ... ")),
        (replaced, F.substr(text, F.lit(1), half)), ("delta", F.substr(text, half + 1)))
    events = F.array(*[
        F.struct(F.lit(i).alias("step"), (F.lit(k) if isinstance(k, str) else k).alias("kind"), t.alias("text"))
        for i, (k, t) in enumerate(steps)])
    numbered = rows.withColumn("n", F.row_number().over(in_order).cast("long"))
    return numbered.select("conv_id", "n", "role", F.explode(events).alias("e")).select(
        "conv_id", (F.col("n") * len(steps) + F.col("e.step")).alias("seq"), F.col("e.kind").alias("kind"),
        F.col("n").cast("string").alias("message_id"), "role", F.col("e.text").alias("text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    back = read_back(render(fold_events(streamed(rows))))
    said_by_turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said_by_turn, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + length(text)
      + length(regexp_replace(role, '[^\\<>]', '', 'g')) + length(regexp_replace(text, '[^\\<]', '', 'g')) + 11)::BIGINT
    AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the texts repeats from some word on a period of its own, as the contract of op11 says."""
    h = id_crc(F.col("doc_id"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    n = F.greatest(F.size("words"), F.lit(1))
    rows = rows.withColumn("a", F.pmod("g", n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    said = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.size("words") > 0, F.array_join(said, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), least=12)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("at"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select("doc_id", "runs", "collapsed", longest.alias("best"), F.array_join(lines, "\n").alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.at")).alias("start"), F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"), F.floor(1000 * F.col("best.n") / -F.col("best.q")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat("lines", F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, s::INT AS step, filter_order[s] AS own, filter_order[1:s - 1] AS earlier FROM orders, range(1, 6) r(s)),
words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM words LEFT JOIN marks USING (doc_id)),
sets AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY 1, 2),
seen AS (
  SELECT *, contains(fails, own) AS has, length(translate(fails, earlier, '')) < length(fails) AS gone FROM sets, steps),
counted AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT has AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (has AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (has AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (has AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (has AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY 1, 2, 3, 4)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM counted
"""


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")


OP13_SQL = r"""
WITH t(template, label, gap, cover, base, words) AS (VALUES %s),
tg AS (
  SELECT *, words[place + 1] AS t1, words[place + 2] AS t2 FROM (SELECT *, unnest(range(0, len(words) - 1)) AS place FROM t)),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
w AS (
  SELECT doc_id, pos, w1, lead(w1) OVER (PARTITION BY doc_id ORDER BY pos) AS w2
  FROM (SELECT doc_id, unnest(words) AS w1, generate_subscripts(words, 1) - 1 AS pos FROM d)),
votes AS (
  SELECT doc_id, template, label, gap, cover, base, len(words) AS size, place, pos - place AS diagonal
  FROM w JOIN tg ON w1 = t1 AND w2 = t2),
lines AS (
  SELECT doc_id, template, diagonal,
    coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > min(gap), true) AS apart
  FROM votes GROUP BY doc_id, template, diagonal),
merged AS (
  SELECT doc_id, template, diagonal, sum(apart::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS merged FROM lines),
compared AS (SELECT *, unnest([place, place + 1]) AS word FROM votes JOIN merged USING (doc_id, template, diagonal)),
spans AS (
  SELECT doc_id, label, base, cover, min(word + diagonal) AS start, count(DISTINCT word) / min(size) AS share
  FROM compared GROUP BY doc_id, template, merged, label, base, cover HAVING count(DISTINCT word) / min(size) >= cover)
SELECT doc_id, len(words)::BIGINT AS n_words, count(start) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
  max(start) FILTER (base) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0)::DOUBLE AS score
FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id, words
""" % ", ".join(
    f"({i}, '{t.label}', {t.gap}, {t.cover}::DOUBLE, {t.base}, {t.words})" for i, t in enumerate(BASE + NOTICES))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return {"op7_exact_dedup": OP7_SQL, "op9_chat_format": OP9_SQL, "op12_filter_audit": OP12_SQL, "op13_license_scan": OP13_SQL}
