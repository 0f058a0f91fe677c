"""A4, A5 and A10 for conversations of any length: one that holds a third of all messages is spread over many tasks.

Messages are cut into ranges of (conversation, order).  What a chunk needs of the earlier ones of its conversation — the message
before it, the number of pairs before it, the last reset — comes from tables of one row per (conversation, chunk).  Results equal
those of the plain forms in ``answer``.  Messages with equal order in one conversation have no defined sequence, as there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry import params
from quarry.operators.answer import history_window
from quarry.streaming.operators import _range_chunks

ASSISTANTS = ("assistant", "ai", "bot")
BLOCK_PAIRS = 1024


def _earlier(conv: str):
    return Window.partitionBy(conv).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)


def _by_chunk(rows: DataFrame, table: DataFrame, conv: str, how: str) -> DataFrame:
    """Rows with the columns of their chunk's row of ``table``; rows without a conversation form one together."""
    t = table.withColumnsRenamed({conv: "_conv", "_pid": "_chunk"})
    return rows.join(t, rows[conv].eqNullSafe(t["_conv"]) & (rows["_pid"] == t["_chunk"]), how).drop("_conv", "_chunk")


def message_pairs_split(messages: DataFrame, conv: str = "conv_id", order: str = "turn", n_parts: int | None = None) -> DataFrame:
    """A5, equal to ``message_pairs``: conv, turn (of the answer), user, assistant, pair_no."""
    m = messages.where(F.col("role").isin("user", *ASSISTANTS)).select(conv, order, "role", "text")
    d = _range_chunks(m, conv, [order], n_parts)
    inside = Window.partitionBy(conv, "_pid").orderBy(order)
    said = F.struct((F.col("role") == "user").alias("asks"), F.col("text").alias("text"))
    d = d.withColumn("_said", said).withColumn("_before", F.lag("_said").over(inside))
    last = d.groupBy(conv, "_pid").agg(F.max_by("_said", order).alias("_last"))
    carried = last.select(conv, "_pid", F.lag("_last").over(Window.partitionBy(conv).orderBy("_pid")).alias("_carried"))
    d = _by_chunk(d, carried, conv, "left").withColumn("_before", F.coalesce("_before", "_carried"))
    p = d.where(F.col("role").isin(*ASSISTANTS) & F.col("_before.asks"))
    counts = p.groupBy(conv, "_pid").agg(F.count("*").alias("_n"))
    offset = counts.select(conv, "_pid", F.coalesce(F.sum("_n").over(_earlier(conv)), F.lit(0)).alias("_offset"))
    p = _by_chunk(p.withColumn("_i", F.row_number().over(inside)), offset, conv, "inner")
    return p.select(conv, order, F.col("_before.text").alias("user"), F.col("text").alias("assistant"),
                    (F.col("_offset") + F.col("_i")).cast("bigint").alias("pair_no"))


def history_window_split(pairs: DataFrame, conv: str = "conv_id", max_turns: int = params.MAX_HISTORY_TURNS,
                         text_turns: int = params.HISTORY_TEXT_TURNS, block: int = BLOCK_PAIRS) -> DataFrame:
    """A4, equal to ``history_window``, on numbered pairs (``pair_no`` from 1 without gaps).

    Pairs are cut into blocks of consecutive numbers; the last ``max_turns`` pairs of a block go along with the next one, as
    history only.  A window covers one (conversation, block)."""
    if block < max_turns:
        raise ValueError(f"block {block} is shorter than the history of {max_turns} pairs")
    own = F.floor((F.col("pair_no") - 1) / block)
    follows = F.floor((F.col("pair_no") - 1 + max_turns) / block)
    d = pairs.withColumn("_block", F.explode(F.sequence(own, follows))).withColumn("_own", F.col("_block") == own)
    d = d.withColumn("_group", F.struct(F.col(conv), F.col("_block")))
    return history_window(d, "_group", max_turns, text_turns).where("_own").drop("_group", "_block", "_own")


def history_after_reset_split(messages: DataFrame, conv: str = "conv_id", order: str = "turn", reset_role: str = "system",
                              n_parts: int | None = None) -> DataFrame:
    """A10, equal to ``history_after_reset``: the messages after their conversation's last reset.

    Messages without an order have no place in a conversation with resets and go there, as in the plain form."""
    d = _range_chunks(messages, conv, [order], n_parts)
    chunks = d.groupBy(conv, "_pid").agg(F.max(F.when(F.col("role") == reset_role, F.col(order))).alias("_r"))
    last = chunks.select(conv, "_pid", F.max("_r").over(Window.partitionBy(conv)).alias("_r"))
    j = _by_chunk(d, last, conv, "left")
    return j.where(F.col("_r").isNull() | F.col(conv).isNull() | (F.col(order) > F.col("_r"))).drop("_r", "_pid")
