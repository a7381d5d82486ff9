"""Spelling variants against comparisons in memory."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from hazardmart.llm import queries
from hazardmart.llm.common import read
from hazardmart.llm.spelling import numbered, spelling_variants, variants, vocabulary

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(docs):
    """Words and their occurrences, run by run."""
    lower = str.maketrans({chr(upper): chr(upper + 32) for upper in range(ord("A"), ord("Z") + 1)})
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if mark % 31 == 0:
                place = mark % len(word)
                word = word[:place] + word[place + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def expected(counts, ratio=10):
    """Near words by all their deletions: equal ones of two words of one length, or a word itself."""
    near = defaultdict(set)
    short = defaultdict(set)
    for word in counts:
        for place in range(len(word)):
            short[word[:place], word[place + 1 :]].add(word)
            less = word[:place] + word[place + 1 :]
            if less in counts:
                near[word].add(less)
                near[less].add(word)
    for group in short.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        if best is not None and counts[best] >= ratio * counts[word]:
            form[word] = best

    def root(word):
        return root(form[word]) if word in form else word

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def found(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_registered_query_on_the_test_tables(spark, sf):
    docs = [(row["doc_id"], row["text"]) for row in read(spark, f"/root/testdata/sf{sf}", "documents").collect()]
    rows = found(queries.op12_spelling_variants(spark, f"/root/testdata/sf{sf}"))
    assert rows == expected(counted(docs))
    assert any(row[1] for row in rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_words_of_few_characters(spark, seed):
    rand = random.Random(seed)
    words = {"".join(rand.choices("abé", k=rand.randint(0, 6))) for _ in range(400)}
    counts = {word: rand.choice([1, 2, 5, 30, 300, 9000]) for word in words}
    frame = spark.createDataFrame(sorted(counts.items(), key=repr), "word string, n long").repartition(7)
    assert found(variants(frame)) == expected(counts)
    assert found(variants(frame, ratio=2)) == expected(counts, 2)


def test_nodes_are_numbered_once_across_ranges(spark):
    keys = sorted({f"{head}{tail}" for head in ("", "common", "commonplace") for tail in ("", "a", "ab", "b", "é", "日本")})
    frame = spark.createDataFrame([(key,) for key in keys], "word string")
    paths = {row["key"]: row["nodes"] for row in numbered(frame).collect()}
    numbers = {}
    for key, nodes in paths.items():
        assert len(nodes) == len(key) + 1
        for length, node in enumerate(nodes):
            assert numbers.setdefault(node, key[:length]) == key[:length]
    assert len(numbers) == len({key[:length] for key in keys for length in range(len(key) + 1)})
    assert sorted(paths, key=lambda key: paths[key][-1]) == keys


def test_one_word_with_a_variant_for_every_character(spark):
    letters = [chr(point) for point in [*range(0x61, 0x7B), *range(0xC0, 0x100)]]
    counts = {"abcdefg": 1000} | {f"abc{letter}efg": 3 for letter in letters if letter != "d"}
    counts |= {f"abcd{letter}efg": 40 for letter in letters}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(variants(frame)) == expected(counts)


def test_nulls_empty_long_and_repeated_rows(spark):
    long = "x" * 3000 + "y"
    docs = [(None, "Wordsome wordsome"), (1, None), (1, ""), (2, "ÀÉword ÀÉWORD"), (2, "ÀÉword ÀÉWORD"), (3, f"{long} {long} {long[1:]}")]
    docs += [(4, f"{long[1:]} one×two÷three one×two÷three 12345678")]
    frame = spark.createDataFrame([(*doc, 5, 6) for doc in docs], "doc_id long, text string, n int, word int")
    assert found(spelling_variants(frame)) == expected(counted(docs))
    assert {row["word"]: row["n"] for row in vocabulary(frame).collect()} == counted(docs)


def test_empty_table(spark):
    assert found(spelling_variants(spark.createDataFrame([], "doc_id long, text string"))) == []
