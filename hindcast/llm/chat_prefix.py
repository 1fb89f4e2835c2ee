"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own, with all turns before
it as context and only its own text under the loss mask.

A formatted turn is ``<s>[INST] role [/INST]\\ntext</s>\\n``. Inside roles and texts a backslash is doubled and a control
string gets a backslash after its first character, so that no control string is left and one substitution undoes it.

Defined results: null role or text counts as empty; turns go by number (null first), then role, then text, so repeated
turn numbers keep a fixed order; a conversation that does not end with an assistant turn gets one more example over
all turns, with nothing trainable, so that every turn is in the output; rows with a null conv_id form one conversation;
an empty table gives no examples; other columns are ignored. DataFrame functions only.

One conversation is one sequence and meets in one task. Its examples are as long as their contexts together: that grows
with the square of its turns by definition of the expansion, but they leave the task one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]\n", "</s>\n"
CONTROL = r"([<\[])(/?(?:s>|INST\]))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def prefix_examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example, turns, whole, text, mask_start, mask_chars.

    ``mask_start`` (0-based) and ``mask_chars`` count code points of ``text``; ``whole`` marks the example that holds
    every turn of its conversation.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
        .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    )
    shaped = grouped.select(
        "conv_id",
        F.transform("t", lambda x: F.concat(F.lit(OPEN), escaped(x.role), F.lit(MIDDLE))).alias("heads"),
        F.transform("t", lambda x: escaped(x.text)).alias("bodies"),
        F.transform("t", lambda x: x.role == "assistant").alias("answers"),
    )
    placed = shaped.select(
        "conv_id", "heads", "bodies", "answers",
        F.filter(
            F.sequence(F.lit(1), F.size("answers")),
            lambda i: F.element_at("answers", i) | (i == F.size("answers")),
        ).alias("ends"),
    )
    exploded = placed.select("*", F.posexplode("ends").alias("example", "turns"))
    count = F.col("turns")
    context = F.array_join(
        F.transform(
            F.slice("heads", F.lit(1), count - 1),
            lambda head, i: F.concat(head, F.element_at("bodies", i + 1), F.lit(CLOSE)),
        ),
        "",
    )
    parts = exploded.select(
        "conv_id", "example", "turns", (count == F.size("answers")).alias("whole"),
        F.element_at("answers", count).alias("trains"),
        F.concat(context, F.element_at("heads", count)).alias("before"),
        F.element_at("bodies", count).alias("body"),
    )
    return parts.select(
        "conv_id", "example", "turns", "whole",
        F.concat("before", "body", F.lit(CLOSE)).alias("text"),
        F.length("before").alias("mask_start"),
        F.when(F.col("trains"), F.length("body")).otherwise(0).alias("mask_chars"),
        "trains",
    )


def turns_in(text: Column) -> Column:
    """The turns of a formatted text, read back: an array of (role, text)."""
    pieces = F.filter(F.split(text, CLOSE), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescaped(F.substring_index(F.substring(x, len(OPEN) + 1, 2**31 - 1), MIDDLE, 1)).alias("role"),
            unescaped(F.substring(x, F.locate(MIDDLE, x) + len(MIDDLE), F.lit(2**31 - 1))).alias("text"),
        ),
    )


def masked(examples: DataFrame) -> Column:
    """The text under the loss mask, unescaped."""
    return unescaped(F.substring(F.col("text"), F.col("mask_start") + 1, F.col("mask_chars")))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, from formatted examples alone: its turns, its trained text and its formatted length."""
    turns = turns_in(F.col("text"))
    told = F.array_join(
        F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = examples.select(
        "conv_id", "example",
        F.when(F.col("whole"), F.size(turns)).alias("n_turns"),
        F.when(F.col("whole"), F.sha2(told.cast("binary"), 256)).alias("turns_sha256"),
        F.when(F.col("trains"), masked(examples)).alias("loss"),
        F.length("text").cast("long").alias("chars"),
    )
    loss = F.array_join(F.transform(F.array_sort("losses"), lambda x: x.loss), "")
    return (
        read.groupBy("conv_id").agg(
            F.max("n_turns").cast("long").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss"))).alias("losses"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"),
            F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
        )
    )
