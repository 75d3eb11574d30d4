"""Two-stage filter: ordered keywords first, stored verdicts on what they let through."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions.nested import merge_right
from ..functions.text import fold_text, is_empty_text, preview, text_key
from ..operators.lexicon import keyword_stage
from ..session import MAX_INLINE_ENTRIES

VERDICT_COLUMNS = ("decisao", "categoria", "confianca", "justificativa")
# Details of the model call, each with its type; a verdict table may lack them.
CALL_COLUMNS = {"tokens_used": "bigint", "response_time": "double", "cached": "boolean"}


def hybrid_filter(
    df: DataFrame,
    text: str,
    lexicon: DataFrame,
    verdicts: DataFrame | None = None,
    on_missing: str = "reject",
    enabled: bool = True,
    kept_only: bool = False,
    id_col: str | None = None,
    inline_bound: int = MAX_INLINE_ENTRIES,
    fold: Callable[[str], Column] = fold_text,
) -> DataFrame:
    """Adds included, reason, details and the marks of each stage to every row.

    ``verdicts`` has one row per key (decisao, categoria, confianca, justificativa, and where known tokens_used,
    response_time and cached); None means stage 1 decides alone. A row that passes stage 1 and has no verdict is rejected,
    or with ``on_missing="keep"`` kept on stage 1 alone. With ``kept_only`` rows that stage
    1 rejects are filtered before the verdict join and do not travel.
    """
    if on_missing not in ("reject", "keep"):
        raise ValueError(on_missing)
    if not enabled:
        nothing = F.struct(*[F.lit(None).cast("string").alias(n) for n in ("grupo_matched", "termo_matched", "criterio")])
        return df.withColumn("included", F.lit(True)).withColumn("reason", F.lit(V.REASON_BYPASS)).withColumn("details", nothing)

    staged = keyword_stage(df, text, lexicon, id_col, inline_bound, fold).withColumn("text_empty", is_empty_text(text))
    passed = F.col("stage1_passed")
    rejected = F.when(F.col("text_empty"), F.col("stage1_reason")).otherwise(
        F.format_string(V.REASON_STAGE1_REJECTED, F.col("stage1_reason")))
    alone = F.format_string(V.REASON_STAGE1_ONLY, F.col("stage1_reason"))
    first = {
        "grupo_matched": F.col("matched_group"),
        "termo_matched": F.col("matched_term"),
        "criterio": F.col("criterion"),
        "objetivo_compra": F.col("preview"),
        "etapa": F.when(~F.col("text_empty"), F.lit(1)),
    }
    if kept_only:
        staged = staged.where(passed)

    if verdicts is None:
        out = staged.withColumn("stage2_passed", F.lit(None).cast("boolean"))
        included, reason, hybrid = passed, F.when(passed, alone).otherwise(rejected), F.lit(False)
        details = merge_right(first, {"filtro_hibrido": F.when(passed, hybrid), "llm_disponivel": F.when(passed, F.lit(False))})
    else:
        # Key and previews are cut before the join, so that the text itself only travels where
        # the caller asks for it.
        keyed = staged.withColumn("_join_key", text_key(text)).withColumn("_long_preview", preview(text, 200))
        if not kept_only:
            # A row that needs no verdict gets a key that no verdict has and that differs from
            # row to row; one shared null key would send all such rows to one task. It is a
            # hash of the row, so a repeated task sends the row to the same place.
            hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
            own_key = F.concat(F.lit("-"), F.xxhash64(*(([id_col] if id_col else hashable))).cast("string"))
            keyed = keyed.withColumn("_join_key", F.when(passed, F.col("_join_key")).otherwise(own_key))
        right = verdicts.select(
            F.col("key").alias("_verdict_key"), *[F.col(c).alias(f"_v_{c}") for c in VERDICT_COLUMNS],
            *[(F.col(c) if c in verdicts.columns else F.lit(None)).cast(kind).alias(f"_v_{c}") for c, kind in CALL_COLUMNS.items()])
        out = keyed.join(right, F.col("_join_key") == F.col("_verdict_key"), "left")
        missing = F.col("_verdict_key").isNull()
        decision = F.coalesce("_v_decisao", F.lit(V.REJECT))
        confidence = F.coalesce("_v_confianca", F.lit(0).cast("bigint"))
        fallback = passed & missing & F.lit(on_missing == "keep")
        second = passed & ~fallback
        out = out.withColumn("stage2_passed", F.when(second, decision == V.APPROVE))
        verdict_reason = F.format_string(V.REASON_VERDICT, decision, confidence)
        both = F.when(decision == V.APPROVE, F.format_string(V.REASON_HYBRID_YES, verdict_reason)).otherwise(
            F.format_string(V.REASON_HYBRID_NO, verdict_reason))
        included = F.coalesce(F.when(fallback, F.lit(True)).otherwise(F.col("stage2_passed")), F.lit(False))
        reason = F.when(~passed, rejected).when(fallback, alone).otherwise(both)
        details = merge_right(first, {
            "llm_decisao": F.when(second, decision),
            "llm_categoria": F.when(second, F.coalesce("_v_categoria", F.lit(""))),
            "llm_confianca": F.when(second, confidence),
            "llm_justificativa": F.when(second, F.coalesce("_v_justificativa", F.lit(""))),
            **{f"llm_{c}": F.when(second, F.col(f"_v_{c}")) for c in CALL_COLUMNS},
            "objetivo_compra": F.when(second, F.col("_long_preview")),
            "filtro_etapa1_motivo": F.when(second, F.col("stage1_reason")),
            "filtro_etapa2_motivo": F.when(second, verdict_reason),
            "filtro_hibrido": F.when(passed, second),
            # A row kept on stage 1 alone says whether a model was there to be asked.
            "llm_disponivel": F.when(fallback, F.lit(True)),
        })
    out = out.withColumn("included", included).withColumn("reason", reason).withColumn("details", details)
    drop = ["_join_key", "_verdict_key", "_long_preview", "stage1_reason", "criterion", "preview"]
    out = out.drop(*drop, *[f"_v_{c}" for c in (*VERDICT_COLUMNS, *CALL_COLUMNS)])
    return out.where("included") if kept_only else out
