"""Token counts and BPE codec against the tokenizer's own library."""

from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hazardmart.llm import bpe_codec, queries, token_counts
from hazardmart.llm.byte_bpe import FOREIGN, PIECES, default_tokenizer
from hazardmart.llm.common import read

LIBRARY = Tokenizer.from_file(default_tokenizer())
PARTS = st.lists(
    st.sampled_from([*"aethz 019.!?'=-\n\té日٣²", "  ", "'ll", "'re", " the", "<|endoftext|>", "endoftext|>", "<|"])
).map("".join)


def library_ids(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_pieces_agree_with_the_library_inside_the_known_ranges():
    for point in range(0xD7A4):
        char = chr(point)
        if not FOREIGN.search(char):
            text = f"a{char}a1{char}.{char}"
            spans = [span for _, span in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
            assert [match.span() for match in PIECES.finditer(text)] == spans, hex(point)


@settings(max_examples=150, deadline=None)
@given(PARTS)
def test_every_prefix_has_the_library_count(text):
    table = token_counts.counter(default_tokenizer()).table(text)
    counts = [0, *np.cumsum(table, dtype=int)]
    assert counts == [len(library_ids(text[:end])) for end in range(len(text) + 1)]


@settings(max_examples=150, deadline=None)
@given(PARTS)
def test_ids_and_decoded_text_equal_the_library(text):
    codec = bpe_codec.codec(default_tokenizer())
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)
    assert codec.decode(ids) == LIBRARY.decode(library_ids(text), skip_special_tokens=False)


def test_long_runs_without_boundaries():
    codec = bpe_codec.codec(default_tokenizer())
    for text in ("a" * 5000, " " * 5000 + "x", "=-" * 3000):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library_ids(text)
        assert token_counts.count_of(token_counts.counter(default_tokenizer()).table(text)) == len(library_ids(text))


def test_documents_and_odd_rows(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "x"), (-3, "x"), (None, "a b")], "doc_id long, text string")
    every = docs.union(odd)
    texts = [(row["doc_id"], row["text"] or "") for row in every.collect()]
    expected = sorted((key is None, key, len(text.encode()), len(library_ids(text))) for key, text in texts)
    rows = token_counts.count_tokens(every).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    digests = bpe_codec.round_trip_digests(every).collect()
    assert sorted((d["n_tokens"]) for d in digests) == sorted(row[3] for row in expected)


def test_stored_tables_answer_budgets(spark):
    text = "One two  three, four!\nfive"
    tables = token_counts.prefix_tables(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    for budget in (0, 1, 4, 100):
        fits = token_counts.within_budget(tables, budget).first()["prefix_chars"]
        assert len(library_ids(text[:fits])) <= budget
        assert all(len(library_ids(text[:end])) > budget for end in range(fits + 1, len(text) + 1))


def test_encode_replaces_clashing_columns_and_decodes_back(spark):
    rows = spark.createDataFrame([(1, "a b", 7), (2, None, 8)], "doc_id long, text string, n_tokens int")
    encoded = bpe_codec.encode(rows)
    assert encoded.columns == ["doc_id", "n_tokens", "token_ids"]
    decoded = {row["doc_id"]: row["text"] for row in bpe_codec.decode(encoded).collect()}
    assert decoded == {1: "a b", 2: ""}


@pytest.mark.parametrize("run", [token_counts.count_tokens, bpe_codec.encode, bpe_codec.round_trip_digests])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_codec_query_has_the_library_digests(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {row["doc_id"]: row["text"] or "" for row in read(spark, sf_dir, "documents").collect()}
    rows = queries.op7_bpe_codec(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library_ids(docs[row["doc_id"]])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == sha256(decoded.encode()).hexdigest()
