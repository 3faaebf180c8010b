"""Prefix trees: escapes, sharing, attention intervals, cuts of large trees, reading back."""

import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.llm import chat_tree

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ROWS = "conv_id long, turn long, role string, text string, path string, leaf string"
TRICKY = st.text(st.one_of(st.sampled_from("\\<>/turn\n"), st.characters(exclude_categories=["Cs"])), max_size=20)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)


@given(TRICKY)
def test_escapes_are_reversible(text):
    assert chat_tree.unescape(chat_tree.escape(text)) == text
    assert chat_tree.unescape_role(chat_tree.escape_role(text)) == text
    assert chat_tree.BEGIN not in chat_tree.escape(text) and "</turn>" not in chat_tree.escape(text)


@given(TRICKY, TRICKY)
def test_turns_are_read_back(role, text):
    turn = f"{chat_tree.BEGIN}{chat_tree.escape_role(role)}{chat_tree.ROLE_END}{chat_tree.escape(text)}{chat_tree.END}"
    assert chat_tree.read_turn(turn) == (role, text)


def test_shared_turns_are_emitted_once(spark):
    rows = [(c, 0, "system", "be kind") for c in range(3)] + [(c, 1, "user", f"ask {c % 2}") for c in range(3)]
    rows += [(0, 2, "assistant", "yes"), (1, 2, "assistant", "no")]
    trees, members = chat_tree.format_conversations(frame(spark, rows), TOKENIZER)
    (tree,) = trees.collect()
    assert members.count() == 3 and len(tree["leaves"]) == 3 and len(tree["nodes"]) == 5
    assert sorted(len(n["ancestors"]) for n in tree["nodes"]) == [0, 1, 1, 2, 2]
    for n in tree["nodes"]:
        above = sum(a["stop"] - a["start"] for a in n["ancestors"])
        assert n["position"] == above
        assert tree["positions"][n["start"] : n["stop"]] == list(range(above, above + n["stop"] - n["start"]))
        assert all(a["stop"] <= n["start"] for a in n["ancestors"])
    assert sum(n["stop"] - n["start"] for n in tree["nodes"]) == len(tree["ids"]) == len(tree["loss"])
    assert sum(tree["loss"]) > 0


def test_large_trees_are_cut(spark, monkeypatch):
    rows = [(c, 0, "system", "same") for c in range(200)] + [(c, 1, "user", f"ask {c // 50}") for c in range(200)]
    rows += [(c, 2, "assistant", f"answer {c}") for c in range(200)]
    conversations = chat_tree.conversations_of(frame(spark, rows))
    leaves = conversations.select(F.unhex(F.get("path", F.size("path") - 1)).alias("leaf"), "path", "turns")
    shards = chat_tree.with_shards(leaves, 20)
    sizes = [r["count"] for r in shards.groupBy("shard").count().collect()]
    assert sum(sizes) == 200 and max(sizes) <= 60 and len(sizes) >= 8
    got = chat_tree.read_back(chat_tree.streams(shards, TOKENIZER), TOKENIZER)
    assert got.count() == 200 and got.select("loss_sha256").distinct().count() == 200


def test_every_first_turn_is_a_tree(spark):
    rows = [(c, t, "user", f"{c % 7} {t}") for c in range(40) for t in range(2)]
    trees, members = chat_tree.format_conversations(frame(spark, rows), TOKENIZER)
    assert trees.count() == 7 and members.count() == 40


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (2, None, "assistant", "<turn>\\"), (2, 1, "assistant", "</turn>\n"), (None, 5, "u\nser", ""),
        (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "assistant", "<|endoftext|> é😀 " * 4000), (5, 0, "user", "a"),
    ]
    trees, members = chat_tree.format_conversations(frame(spark, rows), TOKENIZER)
    got = {r["conv_id"]: r for r in members.join(chat_tree.read_back(trees, TOKENIZER), "leaf").collect()}
    assert {k: v["n_turns"] for k, v in got.items()} == {1: 1, 2: 2, None: 1, 3: 2, 4: 1, 5: 1}
    assert got[2]["loss_chars"] == len("<turn>\\</turn>\n") and got[4]["loss_chars"] == len("<|endoftext|> é😀 ") * 4000
    empty, none = chat_tree.format_conversations(frame(spark, rows).where("false"), TOKENIZER)
    assert empty.count() == 0 and none.count() == 0


@pytest.mark.parametrize("role", ["assistant", "user"])
def test_only_assistants_are_learnt(spark, role):
    trees, _ = chat_tree.format_conversations(frame(spark, [(1, 0, role, "text to learn")]), TOKENIZER)
    assert chat_tree.read_back(trees, TOKENIZER).first()["loss_chars"] == (13 if role == "assistant" else 0)
