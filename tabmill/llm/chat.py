"""Conversations as training text, built and read back with Spark expressions only.

Turns are collected as structs and sorted, adjacent turns of one role are merged into a block by array aggregation, and
blocks are concatenated. The marks of the template, and the escape character, are escaped inside texts and roles,
so the output can be taken apart again without loss. Before every mark the template has a character of its own, never
text, so an unescaped mark is one without a backslash before it.

    <s>user
    [INST] first text [/INST][INST] second text of the same role [/INST]</s><s>assistant
    [INST] answer [/INST]</s>

The loss mask is a list of (start, length) in characters: the texts of the answering role, without marks.

Defined results: null text and null role count as empty; rows of one turn number are ordered by role and text, repeated
rows all stay; null turns come first; rows without conversation id form one conversation; an empty table gives no rows. Other
columns are not read. One conversation becomes one string, so it must fit a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template.
OPEN, CLOSE, BEGIN, END = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = r"(\\|</?s>|\[/?INST\])"
ANSWERS = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + CONTROL, "$1")


def blocks(turns: Column) -> Column:
    """Adjacent turns of one role as one struct (role, texts)."""
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(done, turn):
        last = F.element_at(done, -1)
        alone = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        longer = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        same = (F.size(done) > 0) & (F.when(F.size(done) > 0, last["role"]) == turn["role"])
        return F.when(same, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(alone))
        )

    return F.aggregate(turns, empty, add)


def pieces(merged: Column) -> Column:
    """The output in order, as structs (piece, answer): marks and texts in turn."""

    def mark(text) -> Column:
        return F.struct(F.concat(*text).alias("piece"), F.lit(False).alias("answer"))

    def of_block(block):
        texts = F.transform(
            block["texts"],
            lambda t: F.array(
                mark([F.lit(f"{BEGIN} ")]),
                F.struct(escaped(t).alias("piece"), (block["role"] == ANSWERS).alias("answer")),
                mark([F.lit(f" {END}")]),
            ),
        )
        return F.concat(
            F.array(mark([F.lit(OPEN), escaped(block["role"]), F.lit("\n")])), F.flatten(texts), F.array(mark([F.lit(CLOSE)]))
        )

    return F.flatten(F.transform(merged, of_block))


def loss_spans(parts: Column) -> Column:
    """(start, length) of every answer text, by adding up lengths along the pieces."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(done, part):
        n = F.length(part["piece"])
        span = F.struct(done["at"].alias("start"), n.alias("length"))
        return F.struct(
            (done["at"] + n).alias("at"),
            F.when(part["answer"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"),
        )

    return F.aggregate(parts, start, step)["spans"]


def format_conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: id, ``formatted`` string, ``loss_spans``."""
    row = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return (
        turns.groupBy(F.col(id_col))
        .agg(F.sort_array(F.collect_list(row)).alias("turns"))
        .select(id_col, blocks(F.col("turns")).alias("blocks"))
        .select(id_col, pieces(F.col("blocks")).alias("pieces"))
        .select(
            id_col,
            F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
            loss_spans(F.col("pieces")).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) in order, from the string alone."""
    found = F.filter(F.split(formatted, r"(?<!\\)" + CLOSE), lambda b: b != "")

    def of_block(block):
        head = F.substring_index(block, f"\n{BEGIN} ", 1)
        body = F.substr(block, F.length(head) + F.lit(2))
        texts = F.filter(F.split(body, r" \[/INST\]"), lambda t: t != "")
        return F.transform(
            texts,
            lambda t: F.struct(
                unescaped(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
                unescaped(F.substr(t, F.lit(len(BEGIN) + 2))).alias("text"),
            ),
        )

    return F.flatten(F.transform(found, of_block))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, with nothing between."""
    cut = F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"])))
    return F.array_join(cut, "")


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the output holds when it is read back."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.select(
        id_col,
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").alias("n"),
    ).select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("n").cast("long").alias("formatted_chars"),
    )
