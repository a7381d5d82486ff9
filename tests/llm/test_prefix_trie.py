"""The prefix trie against tries built in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hazardmart.llm import queries
from hazardmart.llm.common import read
from hazardmart.llm.prefix_trie import IDS_AT_ONCE, rebuilt_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences_of(rows):
    """Rebuilt sequences by conversation; turns of one number must be alike."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [(role, text) for *_, role, text in sorted(turns)] for conv, turns in own.items()}
    heads = {conv: zlib.crc32(str(conv).encode()) % 9 for conv in own}
    bases = {conv: conv - int(conv / 5) * 5 for conv in own}  # the remainder has the sign of conv
    return {c: own.get(c - bases[c], [])[: heads[c]] + turns[heads[c] :] for c, turns in own.items()}


def expected(rows):
    members, children = defaultdict(list), defaultdict(set)
    sequences = {conv: tuple(turns) for conv, turns in sequences_of(rows).items()}
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
            if depth:
                children[turns[: depth - 1]].add(turns[:depth])
    result, totals = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[child] for child in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(leaves for leaves, _ in below) or 1, saved + sum(total for _, total in below))
        ends = ",".join(str(conv) for conv in sorted(members[node]) if sequences[conv] == node)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        result.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), *totals[node], digest))
    return sorted(result, key=repr)


def found(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_registered_query_on_the_test_tables(spark, sf):
    rows = [tuple(row[name] for name in ("conv_id", "turn", "role", "text")) for row in read(spark, f"/root/testdata/sf{sf}", "conversations").collect()]
    assert found(queries.op11_prefix_trie(spark, f"/root/testdata/sf{sf}")) == expected(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rand = random.Random(seed)
    rows = [
        (conv, turn, rand.choice(["user", "assistant", None]), rand.choice(["a", "é", "", None]))
        for conv in rand.sample(range(-40, 80), 60)
        for turn in range(rand.choice([1, 2, 3, 5, 9, 17, 40]))
    ]
    rand.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(rebuilt_trie(frame)) == expected(rows)


def test_one_conversation_and_one_first_turn_hold_most_rows(spark):
    rows = [(3, turn, "user", "same") for turn in range(300)]
    rows += [(conv, 0, "user", "same") for conv in range(10, 10 + 3 * IDS_AT_ONCE, 2)]
    assert found(rebuilt_trie(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_nulls_repeats_turnless_and_clashing_columns(spark):
    rows = [(0, None, "user", "x"), (0, 1, None, None), (0, 1, None, None), (None, 0, "user", "lost"), (4, 7, "user", "only")]
    clashing = [(*row, 1, 2, 3) for row in rows]
    frame = spark.createDataFrame(clashing, f"{SCHEMA}, depth int, name int, mark int")
    assert any(not turns for turns in sequences_of([(7, 0, "user", "a"), (9, 0, "user", "b")]).values())
    assert found(rebuilt_trie(frame)) == expected(rows)
    lonely = [(7, 0, "user", "a"), (9, 0, "user", "b")]
    assert found(rebuilt_trie(spark.createDataFrame(lonely, SCHEMA))) == expected(lonely)


def test_empty_table(spark):
    assert found(rebuilt_trie(spark.createDataFrame([], SCHEMA))) == []
