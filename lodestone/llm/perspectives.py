"""Multi-party perspective rotation of conversations, in DataFrame operations only.

For every participant of a conversation, the dialogue is rendered once with that participant's
messages as the assistant's and everyone else's as named users'; system messages keep their role.
Only the assistant's contents, with their end marks, are trained on: ``loss_spans`` lists their
character ranges, and the rest is masked.

A rendering comes in parts of bounded length, so that a conversation of any number of messages
is spread over tasks: part (block, slice) holds the turns of one block of TURNS turn numbers; a
block of more than TURNS messages (turn numbers that tie) is cut into slices by the hash of its
messages, of about TURNS each. Within a part, messages are in order of turn, then hash.
Concatenating a perspective's parts in order of block and slice gives the dialogue.

Defined cases: repeated rows (same conversation, turn, role and text) are one message. A null text
is empty. A null role is a user without a name and no participant; so is an empty one. Null turns
form a block of their own, before all others; null conversations are one conversation. A dialogue
without participants has no rendering. A part holds the messages of its own turns only: a system message stands in the part of
its turn and is not repeated in later ones. Texts of any length are rendered whole; an empty table gives an empty result. "<|" in a text or role is written "< |", so that no text
can forge a message. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = 32
SYSTEM = "system"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", turns: int = TURNS) -> DataFrame:
    """(conv_id, perspective, block, slice, n_messages, n_trained, rendered, loss_spans) for each part of each perspective."""
    role = F.nullif(F.col(role_col).cast("string"), F.lit(""))
    messages = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    messages = messages.distinct().select("conv", "turn", "role", "text", F.floor(F.col("turn") / turns).alias("block"), F.md5(F.concat(F.coalesce("role", F.lit("")), F.lit("|"), "text").cast("binary")).alias("key"))
    # blocks that hold more messages than turns are cut
    crowded = messages.groupBy(F.col("conv").alias("c"), F.col("block").alias("b")).count().where(F.col("count") > turns).withColumn("slices", F.ceil(F.col("count") / turns)).drop("count")
    cut = messages.join(crowded, F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")), "left")
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    # a block of one turn is cut by hash; turns that share a block are cut by turn first
    share = (F.pmod(F.coalesce("turn", F.lit(0)), F.lit(turns)) * (1 << 32) + place) / (turns * (1 << 32))
    placed = cut.withColumn("slice", F.coalesce(F.least(F.floor(share * F.col("slices") * turns), F.col("slices") * turns - 1), F.lit(0)).cast("bigint")).drop("c", "b", "slices")
    parts = placed.groupBy("conv", "block", "slice").agg(F.array_sort(F.collect_list(F.struct("turn", "key", "role", "text"))).alias("said"))
    # parts meet their speakers by runs of parts, so that a long conversation is spread over tasks
    run = F.struct(F.floor(F.col("block") / turns).alias("block"), F.floor(F.col("slice") / turns).alias("slice"))
    parts = parts.withColumn("run", run)
    speakers = messages.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(F.col("conv").alias("of"), F.col("role").alias("perspective")).distinct()
    runs = parts.select("conv", "run").distinct().join(speakers, F.col("conv").eqNullSafe(F.col("of"))).select("of", F.col("run").alias("of_run"), "perspective")
    seen = parts.join(runs, F.col("conv").eqNullSafe(F.col("of")) & F.col("run").eqNullSafe(F.col("of_run")))

    def voiced(m: Column) -> Column:
        mine = F.coalesce(m["role"] == F.col("perspective"), F.lit(False))
        head = F.when(mine, F.lit("<|im_start|>assistant\n")).when(m["role"] == SYSTEM, F.lit("<|im_start|>system\n"))
        head = head.otherwise(F.concat(F.lit("<|im_start|>user"), F.coalesce(F.concat(F.lit(" name="), _safe(m["role"])), F.lit("")), F.lit("\n")))
        return F.struct(head.alias("head"), F.concat(_safe(m["text"]), F.lit("<|im_end|>\n")).alias("body"), mine.alias("mine"))

    parts = seen.select("conv", "perspective", "block", "slice", F.transform("said", voiced).alias("ms"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, m: Column) -> Column:
        begin = state["at"] + F.length(m["head"])
        end = begin + F.length(m["body"])
        span = F.concat(begin.cast("string"), F.lit("-"), (end - 1).cast("string"))  # without the final line break
        return F.struct(end.cast("bigint").alias("at"), F.when(m["mine"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return parts.select(
        F.col("conv").alias(conv_col),
        "perspective",
        "block",
        "slice",
        F.size("ms").cast("bigint").alias("n_messages"),
        F.size(F.filter("ms", lambda m: m["mine"])).cast("bigint").alias("n_trained"),
        F.array_join(F.transform("ms", lambda m: F.concat(m["head"], m["body"])), "").alias("rendered"),
        F.array_join(F.aggregate("ms", start, step, lambda s: s["spans"]), ",").alias("loss_spans"),
    )
