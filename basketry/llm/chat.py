"""Chat rendering from the view of every participant.

For each participant of a conversation the dialogue is rendered with that speaker as assistant,
system turns as system and everyone else as user with a name; the loss mask covers what the
assistant says, with the mark that ends it. Only DataFrame functions are used.

A conversation of any length is rendered in parts: its turns fall into runs of 64 numbers, and
these into pieces of at most 64 messages, so no cell and no task holds a whole conversation. The
pieces of a view, put together in order of (part, piece), are the dialogue.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F


@dataclass(frozen=True)
class ChatFormat:
    """Marks around messages, roles of system turns, and turns in a part."""

    open_mark: str = "<|im_start|>"
    close_mark: str = "<|im_end|>"
    system: str = "system"
    turns: int = 64


def perspectives(turns: DataFrame, fmt: ChatFormat = ChatFormat()) -> DataFrame:
    """One row per conversation, participant, part and piece: conv_id, speaker, part, piece,
    n_messages, text, mask (array of first and last-but-one place, in characters of `text`).

    Input columns are conv_id, turn, role and text; others are ignored. A participant is a role
    other than system; a null role is the participant `unknown`, a null text is empty. A null
    conv_id is a conversation of its own. Messages are in order of turn, role and text, a null turn
    first, in a part of its own with a null number; repeated rows are repeated messages. A mark
    within a text is broken up by a space, so it cannot end a message. A conversation of system
    turns only has no participant and gives no rows, nor does an empty table.
    """
    clean = F.coalesce(F.col("text").cast("string"), F.lit(""))
    clean = F.replace(clean, F.lit("<|"), F.lit("< |"))
    said = turns.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), clean.alias("text"),
    )
    said = said.withColumn("part", F.floor(F.col("turn") / fmt.turns).cast("long"))
    who = said.filter(F.col("role") != fmt.system).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    views = said.join(who, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    order = Window.partitionBy("conv_id", "speaker", "part").orderBy("turn", "role", "text")
    views = views.withColumn("_at", F.row_number().over(order) - 1)
    views = views.withColumn("piece", F.floor(F.col("_at") / fmt.turns).cast("int"))
    own = F.col("role") == F.col("speaker")
    head = F.concat(
        F.lit(fmt.open_mark),
        F.when(F.col("role") == fmt.system, F.lit("system"))
        .when(own, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.col("role"))),
        F.lit("\n"),
    )
    body = F.concat("text", F.lit(fmt.close_mark))
    message = F.struct(F.col("_at").alias("at"), head.alias("head"), body.alias("body"), own.alias("own"))
    pieces = views.groupBy("conv_id", "speaker", "part", "piece").agg(F.array_sort(F.collect_list(message)).alias("m"))
    # One walk over at most 64 messages: the length so far and the spans of the assistant.
    start = F.struct(F.lit(0).cast("int").alias("end"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(done, m):
        begin = done["end"] + F.char_length(m["head"])
        stop = begin + F.char_length(m["body"])
        span = F.array(F.struct(begin.alias("start"), stop.alias("stop")))
        spans = F.when(m["own"], F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((stop + 1).alias("end"), spans.alias("spans"))

    text = F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["body"], F.lit("\n"))), "")
    return pieces.select(
        "conv_id", "speaker", "part", "piece", F.size("m").alias("n_messages"), text.alias("text"),
        F.aggregate("m", start, step)["spans"].alias("mask"),
    )
