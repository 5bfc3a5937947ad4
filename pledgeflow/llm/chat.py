"""Preference formatting: the common prompt of two conversations once, and both completions with loss masks.

The turns of a pair are put side by side by key and turn number. The longest
prefix in which both sides say the same is the prompt; what follows on each side is
its completion. A mask is run-length coded: pieces of (length in code points,
loss), where only what an assistant says has a loss.

DataFrame functions only. Turns are compared per key and turn, before the turns of one
conversation, which is one output row, come together.

Defined cases: null roles and texts count as empty; a null turn number comes first;
rows without a key belong to no pair and are left out; messages of one
side with the same turn number are one turn, in the order of role and text, and equal ones count
once; a pair with one side only has an empty prompt and an empty completion for
the other; two equal conversations are all prompt; an empty table gives an empty result.
The result has the columns listed at ``format_pairs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: What stands before, between and after role and text of a message.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n"


def _turns(rows: DataFrame, key: str, side: int) -> DataFrame:
    return rows.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"),
        F.lit(side).alias("side"),
        F.col("turn").cast("long").alias("turn"),
        F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"),
    )


def _rendered(messages: Column) -> Column:
    return F.array_join(
        F.transform(messages, lambda m: F.concat(F.lit(OPEN), m["role"], F.lit(MIDDLE), m["text"], F.lit(CLOSE))), ""
    )


def _mask(messages: Column) -> Column:
    """Pieces of (length, loss): head, text and end of each message."""
    def pieces(m: Column) -> Column:
        head = F.length(m["role"]) + len(OPEN + MIDDLE)
        return F.array(
            F.struct(head.alias("length"), F.lit(False).alias("loss")),
            F.struct(F.length(m["text"]).alias("length"), (m["role"] == ASSISTANT).alias("loss")),
            F.struct(F.lit(len(CLOSE)).alias("length"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(messages, pieces))


def format_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """One row per key of two tables of (key, turn, role, text).

    key, prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask.
    """
    rows = _turns(chosen, key, 0).unionByName(_turns(rejected, key, 1)).distinct()
    said = [F.sort_array(F.collect_list(F.when(F.col("side") == n, F.col("said")))).alias(c) for n, c in enumerate("cr")]
    turns = rows.groupBy("key", "turn").agg(*said)
    turn = F.struct(F.coalesce("turn", F.lit(-(1 << 63))).alias("turn"), "c", "r", (F.col("c") == F.col("r")).alias("same"))
    pairs = turns.groupBy("key").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    split = F.array_min(F.transform(F.filter("turns", lambda t: ~t["same"]), lambda t: t["turn"]))
    parted = pairs.withColumn("split", split)
    before = F.filter("turns", lambda t: F.col("split").isNull() | (t["turn"] < F.col("split")))
    after = F.filter("turns", lambda t: t["turn"] >= F.col("split"))

    def side(name: str) -> Column:
        return F.flatten(F.transform(F.coalesce(after, F.array()), lambda t: t[name]))

    messages = parted.select(
        "key",
        F.size(before).alias("prompt_turns"),
        F.flatten(F.transform(before, lambda t: t["c"])).alias("prompt"),
        side("c").alias("chosen"),
        side("r").alias("rejected"),
    )
    return messages.select(
        F.col("key").alias(key),
        "prompt_turns",
        _rendered(F.col("prompt")).alias("prompt"),
        _rendered(F.col("chosen")).alias("chosen"),
        _mask(F.col("chosen")).alias("chosen_mask"),
        _rendered(F.col("rejected")).alias("rejected"),
        _mask(F.col("rejected")).alias("rejected_mask"),
    )
