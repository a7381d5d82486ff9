"""Packing against the tokenizer's library and best fit decreasing, piece by piece."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hazardmart.llm import queries
from hazardmart.llm.byte_bpe import default_tokenizer
from hazardmart.llm.common import read
from hazardmart.llm.packing import PackOptions, pack, plan, sequences
from hazardmart.llm.word_bpe import TextEncoder, has_ranks, word_tokenizer

LIBRARY = Tokenizer.from_file(word_tokenizer())
PARTS = st.lists(
    st.sampled_from(
        [*"aBÉß'1٣²½ªµİΣς.!_-×÷日ﬁ́\x00\t\n\x1c\x85　 ", "'s", "'LL", " the ", "<|endoftext|>", "<|", "|>", "Å"]
    )
).map("".join)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def best_fit(lengths, capacity):
    """Space left in each sequence after packing piece by piece, the longest first."""
    spaces = []
    for length in sorted(lengths, reverse=True):
        fitting = [at for at, space in enumerate(spaces) if space >= length]
        if fitting:
            spaces[min(fitting, key=spaces.__getitem__)] -= length
        else:
            spaces.append(capacity - length)
    return sorted(spaces)


def assert_packed(rows, capacity):
    """Sequences are numbered from 0 and hold their pieces without gaps; as few as best fit needs."""
    places = defaultdict(list)
    for row in rows:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    assert sorted(places) == [*range(len(places))]
    for own in places.values():
        own.sort()
        assert [offset for offset, _ in own] == [sum(length for _, length in own[:at]) for at in range(len(own))]
        assert sum(length for _, length in own) <= capacity
    assert sorted(capacity - sum(length for _, length in own) for own in places.values()) == best_fit(
        [row["length"] for row in rows], capacity
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=4), st.integers(1, 50))
def test_ids_equal_the_library(texts, remembered):
    encode = TextEncoder(word_tokenizer(), has_ranks(word_tokenizer()), remembered)
    for _ in range(2):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)] == [library_ids(text) for text in texts]


def test_every_character_is_split_as_the_library_does():
    encode = TextEncoder(word_tokenizer(), True, 1000)
    texts = [f"a{chr(point)}b'{chr(point)}s 1{chr(point)}" for point in range(0x3100)]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), ascii(text)


def test_only_word_vocabularies_have_ranks():
    assert has_ranks(word_tokenizer()) and not has_ranks(default_tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=80))))
def test_plan_packs_like_best_fit_of_single_pieces(case):
    capacity, lengths = case
    planned, counts, rows = plan(Counter(lengths), capacity), Counter(lengths), []
    for length, count in counts.items():
        own = [row for row in planned.tolist() if row[0] == length]
        for rank in range(count):
            _, first, sequence, stacked, offset = [row for row in own if row[1] <= rank][-1]
            beyond = rank - first
            rows.append({"length": length, "sequence_id": sequence + beyond // stacked, "offset": offset + beyond % stacked * length})
    assert_packed(rows, capacity)


def test_plan_stays_small_whatever_the_counts():
    planned = plan({length: 10**12 + length * 7919 for length in range(1, 2049)}, 2048)
    assert len(planned) <= 3 * 2048 * 11


def test_registered_query_packs_all_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").collect()
    rows = queries.op13_best_fit_packing(spark, sf_dir).collect()
    expected = []
    for doc in docs:
        ids = [*library_ids(doc["text"] or ""), 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((doc["doc_id"], piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(expected)
    assert_packed(rows, 2048)


def test_odd_rows_and_sequences(spark):
    long = " ".join(["word"] * 50 + ["x" * 3000])
    odd = [(1, None, 7), (1, "", 7), (None, "a b", 7), (2, "same", 7), (2, "same", 7), (3, long, 7)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, length int").repartition(3)
    packed = pack(docs, PackOptions(capacity=16, separator=9))
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows = packed.collect()
    assert_packed(rows, 16)
    whole = defaultdict(list)
    for row in sorted(rows, key=lambda row: row["start"]):
        if row["doc_id"] == 3:
            whole[3] += np.frombuffer(row["ids"], "<u4").tolist()
    assert whole[3] == [*library_ids(long), 9]
    by_sequence = {row["sequence_id"]: row for row in sequences(packed).collect()}
    for row in rows:
        own = by_sequence[row["sequence_id"]]
        assert own["ids"][4 * row["offset"] : 4 * (row["offset"] + row["length"])] == row["ids"]
        assert row["doc_id"] in own["doc_ids"] and len(own["ids"]) == 4 * own["n_tokens"]


@pytest.mark.parametrize("other", [None, default_tokenizer()])
def test_other_tokenizers_and_empty_tables(spark, other):
    options = PackOptions(tokenizer=other)
    assert pack(spark.createDataFrame([], "doc_id long, text string"), options).collect() == []
    (row,) = pack(spark.createDataFrame([(1, "Some text")], "doc_id long, text string"), options).collect()
    library = Tokenizer.from_file(other or word_tokenizer())
    assert np.frombuffer(row["ids"], "<u4").tolist() == [*library.encode("Some text").ids, 0]
