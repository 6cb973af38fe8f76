"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

The longest common prefix of turns is found by joining the two sides turn by turn: it ends before the first turn number
at which a side lacks the turn or differs in role or text. Its turns are rendered once, as the prompt; what follows on
either side is that side's completion. The result has a row for each rendered turn, so a conversation of any length is
spread over the tasks; in a completion the loss covers the words and the end mark of assistant turns, and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _turns(conversations: DataFrame, key: str) -> DataFrame:
    """One row for each turn number of a conversation.

    Equal rows count once; of different rows with one turn number the smallest by role and text counts. Rows without a
    conversation are left out; a missing turn number comes last, a missing role is ``unknown``, a missing text empty.
    """
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(2**63 - 1)).alias("turn")
    said = F.struct(F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.filter(F.col(key).isNotNull()).select(F.col(key).alias("pair_id"), turn, said.alias("said"))
    return rows.groupBy("pair_id", "turn").agg(F.min("said").alias("said"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit(END))


def preference_segments(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Rows (pair_id, part, turn, role, rendered, loss_start, loss_end) for pairs of conversations (key, turn, role,
    text).

    ``part`` is prompt, chosen or rejected. The loss covers the characters from ``loss_start`` to ``loss_end``, an empty
    span in the prompt and in turns that are not the assistant's. A pair that is known to one side only has no common
    prefix; equal conversations are all prompt.
    """
    a = _turns(chosen, key).withColumnRenamed("said", "a")
    b = _turns(rejected, key).withColumnRenamed("said", "b")
    both = a.join(b, ["pair_id", "turn"], "full")
    parts = both.filter(~F.col("a").eqNullSafe(F.col("b"))).groupBy("pair_id").agg(F.min("turn").alias("parting"))
    placed = both.join(parts, "pair_id", "left")
    shared = F.col("parting").isNull() | (F.col("turn") < F.col("parting"))
    segment = lambda part, said: F.struct(F.lit(part).alias("part"), said.alias("said"))
    segments = F.when(shared, F.array(segment("prompt", F.col("a")))).otherwise(
        F.filter(F.array(segment("chosen", F.col("a")), segment("rejected", F.col("b"))), lambda s: s["said"].isNotNull())
    )
    rows = placed.select("pair_id", "turn", F.inline(segments)).select(
        "pair_id", "part", "turn", F.col("said.role").alias("role"), rendered(F.col("said.role"), F.col("said.text")).alias("rendered")
    )
    learns = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    head = F.length(F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
    return rows.select(
        "*",
        F.when(learns, head).otherwise(0).cast("int").alias("loss_start"),
        F.when(learns, F.length("rendered")).otherwise(0).cast("int").alias("loss_end"),
    )


def swapped_replies(conversations: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected conversations from plain ones: up to its last assistant turn a conversation is chosen, and
    with that turn replaced by the last assistant turn of its neighbour it is rejected.

    Neighbours are an even id and the odd one after it. Without a neighbour that has a reply the rejected side has none.
    Conversations without an assistant turn make no pair.
    """
    turns = _turns(conversations, key).select("pair_id", "turn", "said.role", "said.text")
    last = turns.filter("role = 'assistant'").groupBy("pair_id").agg(F.max("turn").alias("last"))
    own = turns.join(last, "pair_id").filter("turn <= last")
    final = own.filter("turn = last").select("pair_id", "turn", "role", "text")
    even = F.col("pair_id").cast("long").bitwiseXOR(F.lit(1))
    replies = final.select(even.alias("pair_id"), F.col("role").alias("r"), F.col("text").alias("t"))
    replaced = final.join(replies, "pair_id").select("pair_id", "turn", F.col("r").alias("role"), F.col("t").alias("text"))
    rejected = own.filter("turn < last").select("pair_id", "turn", "role", "text").union(replaced)
    return own.select("pair_id", "turn", "role", "text"), rejected
