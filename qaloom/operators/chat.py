"""Bounded conversation memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.text import qa_text
from qaloom.operators.ordered import SPAN, number_rows, with_neighbours

MEMORY = 5
CONTEXT = 3


def _exchange() -> Column:
    return F.struct("question", "answer")


def context_text(exchanges: Column, question: Column) -> Column:
    """Exchanges, then the open question and assistant marker, one per line."""
    past = F.transform(exchanges, lambda e: qa_text(e["question"], e["answer"]))
    now = F.concat(F.lit(fv.HUMAN + " "), question, F.lit("\n" + fv.ASSISTANT))
    return F.array_join(F.concat(past, F.array(now)), "\n")


def chat_context(exchanges: DataFrame, k: int = CONTEXT, span: int = SPAN) -> DataFrame:
    """Per exchange: the text sent to the model, with up to ``k`` exchanges before it."""
    numbered = number_rows(exchanges, ["conv_id"], "turn", "exchange_no", span)
    past = Window.partitionBy("conv_id", "_block").orderBy("exchange_no").rowsBetween(-k, -1)
    return (
        with_neighbours(numbered, "exchange_no", back=k, span=span)
        .withColumn("_past", F.collect_list(_exchange()).over(past))
        .where("_own")
        .select(
            "conv_id",
            "turn",
            "exchange_no",
            F.size("_past").alias("n_past"),
            context_text(F.col("_past"), F.col("question")).alias("context"),
        )
    )


def chat_memory(exchanges: DataFrame, cap: int = MEMORY, k: int = CONTEXT) -> DataFrame:
    """Per conversation: the newest ``cap`` exchanges and what the next prompt would hold.

    Every task passes on at most ``cap`` rows per conversation.
    """
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    listed = F.array_sort(F.collect_list(F.struct("turn", "question", "answer")))
    kept = F.col("memory")
    asked = F.lit("[Your next question]")
    return (
        exchanges.select("conv_id", "turn", "question", "answer")
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= cap)
        .groupBy("conv_id")
        .agg(listed.alias("memory"))
        .withColumn("n_kept", F.size(kept))
        .withColumn("occupancy", F.concat_ws("/", F.size(kept).cast("string"), F.lit(str(cap))))
        .withColumn(
            "context_length",
            F.length(context_text(F.slice(kept, F.greatest(F.size(kept) - k + 1, F.lit(1)), k), asked)),
        )
    )


def render_chat(conversations: DataFrame, eos: str = fv.END_TOKEN) -> DataFrame:
    """Chat template: one row per conversation, each message followed by the end token."""
    message = F.concat(F.coalesce("text", F.lit("")), F.lit(eos))
    pieces = F.array_sort(F.collect_list(F.struct("turn", message.alias("t"))))
    return (
        conversations.groupBy("conv_id")
        .agg(pieces.alias("_pieces"))
        .select("conv_id", F.array_join(F.col("_pieces.t"), "").alias("rendered"))
    )
