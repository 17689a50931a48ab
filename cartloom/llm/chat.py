"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its
reply is trainable. A conversation that does not end with a reply gives one more example without a
trainable part, so the output holds every turn.

The output of a conversation grows with the square of its turns, which is what the method asks
for; the examples of a conversation are made one after the other, so a task holds one at a time.

Null roles and texts count as empty, null turns come first, rows with equal turns are ordered by
role and text, repeated rows are repeated turns, rows without a conversation id form one
conversation, and an empty table gives no example. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import text_or_empty

TURN_START, TEXT_START, TURN_END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Strings that models read as control strings. "<|" begins all marks of the template.
CONTROL_STRINGS = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    """No control string is left whole: a backslash follows its first character."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL_STRINGS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def prefix_target_examples(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trainable: str = "assistant",
) -> DataFrame:
    """One row per example: ``conv_id``, ``n_turns`` in it, ``formatted``, and its loss mask, the
    code points from ``loss_start`` to before ``loss_end`` (both null if nothing is trainable);
    ``is_last`` marks the example that holds the whole conversation.
    """
    one = F.struct(
        F.col(turn).alias("turn"), text_or_empty(F.col(role)).alias("role"), text_or_empty(F.col(text)).alias("text")
    )
    turns = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    rendered = turns.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == trainable).alias("trains"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("text_chars"),
        F.transform("turns", lambda t: F.concat(
            F.lit(TURN_START), escape(t["role"]), F.lit(TEXT_START), escape(t["text"]), F.lit(TURN_END)
        )).alias("rendered"),
    )
    size = F.size("rendered")
    ends = F.filter(F.sequence(F.lit(1), size), lambda k: F.element_at("trains", k) | (k == size))
    examples = rendered.select(
        "conv_id", "trains", "text_chars", "rendered", size.alias("size"), F.explode(ends).alias("n_turns")
    ).select(
        "conv_id", "n_turns",
        (F.col("n_turns") == F.col("size")).alias("is_last"),
        F.element_at("trains", F.col("n_turns")).alias("trained"),
        F.element_at("text_chars", F.col("n_turns")).alias("reply_chars"),
        F.array_join(F.slice("rendered", 1, F.col("n_turns")), "").alias("formatted"),
    )
    end = F.length("formatted") - F.lit(len(TURN_END))
    return examples.select(
        "conv_id", "n_turns", "is_last", "formatted",
        F.when(F.col("trained"), end - F.col("reply_chars")).alias("loss_start"),
        F.when(F.col("trained"), end).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted example, unescaped, as an array of structs."""
    pieces = F.filter(F.split(formatted, r"\Q" + TURN_END + r"\E", -1), lambda p: p != "")
    inner = F.transform(pieces, lambda p: F.substring(p, len(TURN_START) + 1, 2147483647))
    return F.transform(inner, lambda p: F.struct(
        unescape(F.substring_index(p, TEXT_START, 1)).alias("role"),
        unescape(F.substring_index(p, TEXT_START, -1)).alias("text"),
    ))


def conversation_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, loss text and sizes."""
    turns = read_turns(F.col("formatted"))
    joined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    reply = unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select(
        "conv_id",
        F.when(F.col("is_last"), F.size(turns)).alias("n_turns"),
        F.when(F.col("is_last"), F.sha2(joined, 256)).alias("turns_sha256"),
        F.when(F.col("loss_end").isNotNull(), F.struct(F.col("n_turns").alias("at"), reply.alias("reply"))).alias("loss"),
        F.length("formatted").alias("formatted_chars"),
    )
    per = read.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["reply"]), "").alias("loss"),
        F.sum("formatted_chars").cast("long").alias("formatted_chars"),
    )
    return per.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars",
    )
