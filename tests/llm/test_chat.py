"""Formatting and reading back conversations."""

import hashlib

import pytest

from tabmill.llm import chat

NASTY = [
    "", " ", "\n", "\\", "\\\\", "</s>", "<s>", "[INST]", "[/INST]", " [/INST]", "x [/INST][INST] y", "\\</s>", "\\\\</s>", "<</s>s>",
    "[[INST]]", "ends with \\", "é日本\U0001f600 </s>", "</s>[INST] ok [/INST]", "\n[INST] a", "a\x00b",
]


def formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_every_text_comes_back(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(NASTY)]
    rows += [(2, i, f"role {t}", t) for i, t in enumerate(NASTY)]
    df = formatted(spark, rows)
    back = {r[0]: [tuple(x) for x in r[1]] for r in df.select("conv_id", chat.read_turns(df["formatted"])).collect()}
    for conv in (1, 2):
        assert back[conv] == [(r[2], r[3]) for r in rows if r[0] == conv]


def test_loss_is_the_answers_and_nothing_else(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    df = formatted(spark, rows)
    (loss,) = df.select(chat.read_loss(df["formatted"], df["loss_spans"])).first()
    assert loss == "".join(t for i, t in enumerate(NASTY) if i % 2)


def test_adjacent_turns_of_a_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]
    assert formatted(spark, rows).first()["formatted"] == (
        "<s>user\n[INST] a [/INST][INST] b [/INST]</s><s>assistant\n[INST] c [/INST]</s><s>user\n[INST] d [/INST]</s>"
    )


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [(None, None, None, None, 1), (7, 1, "user", "b", 1), (7, 1, "user", "a", 2), (7, 1, "user", "a", 2), (7, None, None, "first", 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert got[None]["n_turns"] == 1 and got[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()
    said = "\nfirst\nuser\na\nuser\na\nuser\nb\n"
    assert got[7]["n_turns"] == 4 and got[7]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[7]["loss_chars"] == 0 and got[7]["loss_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert chat.digest(formatted(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 3000])
def test_long_conversations(spark, n):
    rows = [(1, i, "user" if i % 2 else "assistant", f"{i} </s>") for i in range(n)]
    got = chat.digest(formatted(spark, rows)).first()
    assert got["n_turns"] == n
    assert got["loss_chars"] == sum(len(f"{i} </s>") for i in range(0, n, 2))
