"""The conversation prefix trie against plain prefixes, and the query against its SQL."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest

from trialweave.llm import prefix_trie
from trialweave.llm.queries import ORACLE_SQL, QUERIES

from . import brute
from .test_operators import crowded

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def nodes(frame):
    return Counter(tuple(row[c] for c in COLUMNS) for row in prefix_trie.prefix_trie(frame).collect())


def frame_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def chats(seed, first=-5, last=30, words=("x", "yy", "𝔷é", "", None)):
    chance = random.Random(seed)
    return [
        (conv, chance.choice([turn, turn, None]), chance.choice(["u", "a", None]), chance.choice(words))
        for conv in range(first, last)
        for turn in range(chance.randrange(8))
    ]


def test_nodes_equal_plain_prefixes(spark):
    rows = chats(1) + chats(2, 95, 140) + chats(3, 195, 215, ("x",)) + [(None, 1, "u", "lost")]
    assert nodes(crowded(frame_of(spark, rows))) == brute.trie(rows)


def test_a_long_conversation_and_a_common_first_turn(spark):
    """One conversation, which others share, holds most rows; repeated rows are turns of their own."""
    rows = [(0, i // 2, "u", f"t{i % 3}") for i in range(400)]
    rows += [(200 + c, turn, "u", f"t{turn % 3}") for c in range(4) for turn in range(60 + c)]
    rows += [(300 + c, 0, "u", "hello") for c in range(150)] + [(300 + c, 1, "a", str(c % 7)) for c in range(150)]
    rows += [(7, None, None, None)] * 50
    assert nodes(frame_of(spark, rows)) == brute.trie(rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    # Alone in its family and shorter than what it would share, a conversation is left without turns.
    rows = [(conv, 0, "u", "x") for conv in range(501, 520)]
    found = nodes(frame_of(spark, rows))
    assert found == brute.trie(rows)
    assert any(row[1] == 0 and row[3] == 19 and row[7] != brute.sha(b"") for row in found)


def test_no_conversations(spark):
    assert not nodes(frame_of(spark, []))
    assert not nodes(frame_of(spark, [(None, 1, "u", "x")]))
    one = frame_of(spark, [(100, None, None, None)])
    assert nodes(one) == brute.trie([(100, None, None, None)])


def test_runs_of_ids_are_hashed_in_order(spark, monkeypatch):
    rows = [(conv, 0, "u", "same") for conv in range(1000, 1300)]
    expected = brute.trie(rows)
    monkeypatch.setattr(prefix_trie, "RUN_IDS", 7)
    assert nodes(frame_of(spark, rows)) == expected


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_the_query_equals_its_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
        want = duck.execute(ORACLE_SQL["op12_prefix_trie"])
        names = [column[0] for column in want.description]
        expected = Counter(want.fetchall())
    out = QUERIES["op12_prefix_trie"](spark, folder)
    assert Counter(tuple(row[c] for c in names) for row in out.collect()) == expected
    assert sorted(names) == sorted(out.columns)
