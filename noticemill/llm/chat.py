r"""Chat formatting from an event log.

A log holds events of conversations: ``message`` starts a message, ``delta`` appends to it,
``edit`` and ``regenerate`` replace what it says so far, ``delete`` takes it back. Events are
partitioned by conversation, sorted by sequence and folded into final messages; these are
rendered into one string with a loss mask over what assistants say. All steps are DataFrame operations.

Template: ``<role>`` newline, text, ``</turn>`` newline for each turn. In roles and texts ``\`` becomes ``\b``
and ``<`` becomes ``\l`` (in roles ``>`` becomes ``\g``); so a marker cannot occur inside a text, and the way back is unique.

Each conversation becomes one string, so one conversation's messages meet in one task: that is
the size of a result row. Conversations of the same content are rows of their own and do not meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_END = "</turn>\n"
RESETS = ("message", "edit", "regenerate", "delete")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The way back: every backslash has its letter behind it, so no pair can arise from two neighbours."""
    return F.replace(
        F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of a log: ``conv_id, pos, role, text``; ``pos`` orders the messages of a conversation.

    ``events`` has ``conv_id, seq, kind, message_id, role, text``. An event without ``message_id`` belongs to
    the last ``message`` event before it. Null kind: ``message``; null text: empty; null seq: first; a null
    conversation is one of its own. Ties in seq are ordered by kind (messages first), role and text; repeated
    rows are events of their own. A message's role is the first one given (none: empty), its place that of its
    first event. Events before any ``message`` make up a message.
    """
    kind = F.coalesce(F.col("kind"), F.lit("message"))
    log = events.select(
        "conv_id", F.col("seq"), kind.alias("kind"), F.col("message_id").cast("string").alias("message_id"),
        F.col("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy("seq", F.when(F.col("kind") == "message", 0).otherwise(1), "role", "text")
    starts = F.sum(F.when((F.col("kind") == "message") & F.col("message_id").isNull(), 1).otherwise(0))
    log = log.select(
        "*",
        F.row_number().over(in_order).alias("pos"),
        starts.over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("starts"),
    ).withColumn("starts", F.when(F.col("message_id").isNull(), F.col("starts")))
    folded = log.groupBy("conv_id", "message_id", "starts").agg(
        F.sort_array(F.collect_list(F.struct("pos", "kind", "role", "text"))).alias("events"),
        F.min("pos").alias("pos"),
        F.max(F.when(F.col("kind").isin(*RESETS), F.col("pos"))).alias("reset"),
    )
    live = F.filter("events", lambda e: e["pos"] >= F.coalesce(F.col("reset"), F.lit(0)))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return folded.filter(~F.exists("events", lambda e: (e["pos"] == F.col("reset")) & (e["kind"] == "delete"))).select(
        "conv_id", "pos",
        F.coalesce(F.try_element_at(roles, F.lit(1)), F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``: spans are ``start`` (from 0) and ``n_chars``, in code points.

    ``messages`` has ``conv_id, pos, role, text``. A null role or text is empty, a null ``pos`` comes first, and
    messages of the same ``pos`` are ordered by role and text.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit("<"), F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit(">\n"))
    turns = messages.select(
        "conv_id", "pos", head.alias("head"), escape(text).alias("body"), (role == loss_role).alias("loss"))
    before = Window.partitionBy("conv_id").orderBy("pos", "head", "body").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + F.lit(len(TURN_END))
    turns = turns.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("pos", "head", "body", F.when(
        F.col("loss"), F.struct(F.col("start"), F.length("body").cast("long").alias("n_chars"))).alias("span"))
    per_conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return per_conv.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))), "").alias("formatted"),
        F.array_compact(F.transform("turns", lambda t: t["span"])).alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id, turns`` (role and text as they were), ``loss_text`` and ``formatted_chars`` of rendered rows."""
    parts = F.slice(F.split("formatted", TURN_END, -1), F.lit(1), F.size(F.split("formatted", TURN_END, -1)) - 1)

    def turn(part: Column) -> Column:
        role_end = F.position(F.lit(">\n"), part)
        return F.struct(
            unescape(F.substr(part, F.lit(2), role_end - 2)).alias("role"), unescape(F.substr(part, role_end + 2)).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["n_chars"].cast("int"))))
    return rendered.select(
        "conv_id", F.transform(parts, turn).alias("turns"), F.array_join(loss, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"))
