"""Conversations as training examples by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, only its reply is trainable. A
conversation that ends with another role gives one more example, without a target, so that no turn is lost. The loss mask is a
range of characters of the example's text.

A turn is ``### role``, a line feed, the text, ``</turn>`` and a line feed. Roles are URL-encoded; in texts a backslash
goes before every backslash, before ``/`` in ``</turn>`` and before every ``#`` that follows another, so that no text can
hold a mark of the template; taking the character behind each backslash restores it.

Defined results: null texts and null roles are empty; turns are ordered by turn, nulls first, ties by role and text;
repeated rows are turns of their own; rows with a null conversation id are one conversation; an empty table gives an empty
result; other columns are not read. A conversation is one row, as its last example holds all of it, and its examples
together have a length that grows with the square of its turns: that is what the expansion is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END, TARGET = "### ", "</turn>\n", "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=<)/(?=turn>)|(?<=#)#", r"\\$0")


def restored(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, example, text, loss_start, loss_end``: the target is ``text[loss_start:loss_end]`` in characters."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    head = F.concat(F.lit(HEAD), F.url_encode(who), F.lit("\n"))
    one = turns.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), who.alias("role"), said.alias("said"), head.alias("head"), escaped(said).alias("body")).alias("t"))
    whole = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    parts = whole.select("conv_id", "ts", F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END))).alias("parts"))
    each = parts.select("conv_id", "parts", F.posexplode("ts").alias("at", "t"))
    is_target = F.col("t.role") == TARGET
    text_ = F.array_join(F.slice("parts", F.lit(1), F.col("at") + 1), "")
    kept = each.where(is_target | (F.col("at") == F.size("parts") - 1)).select(
        "conv_id", F.col("at").alias("example"), text_.alias("text"), F.when(is_target, F.length("t.body")).otherwise(0).alias("body"))
    end = F.length("text") - len(END)
    return kept.select("conv_id", "example", "text", (end - F.col("body")).alias("loss_start"), end.alias("loss_end"))


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation ``turns``, an array of role and text, ``losses``, the texts under the masks in order, and ``formatted_chars``."""
    target = F.expr("substring(text, loss_start + 1, loss_end - loss_start)")
    grouped = made.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"), F.sum(F.length("text")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("loss_end") > F.col("loss_start"), F.struct("example", restored(target).alias("said"))))).alias("l"))
    pieces = F.filter(F.split("text", END), lambda x: x != "")
    turns = F.transform(pieces, lambda x: F.struct(
        F.url_decode(F.substring_index(x.substr(F.lit(len(HEAD) + 1), F.length(x)), "\n", 1)).alias("role"),
        restored(x.substr(F.instr(x, "\n") + 1, F.length(x))).alias("said")))
    return grouped.select("conv_id", turns.alias("turns"), F.transform("l", lambda x: x["said"]).alias("losses"), "formatted_chars")
