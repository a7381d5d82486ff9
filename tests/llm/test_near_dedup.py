"""Near-duplicates against all pairs."""

import re
import string

from hazardmart.llm.common import read
from hazardmart.llm.near_dedup import near_duplicates, without_duplicates

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    sets = {key: shingle_set(text) for key, text in rows}
    component = {key: key for key in sets}

    def root(key):
        while component[key] != key:
            key = component[key]
        return key

    keys = sorted(sets)
    for place, one in enumerate(keys):
        for other in keys[place + 1 :]:
            shared, union = len(sets[one] & sets[other]), len(sets[one] | sets[other])
            if shared and 100 * shared >= 75 * union:
                low, high = sorted((root(one), root(other)))
                component[high] = low
    return {key: (len(sets[key]), root(key), root(key) == key) for key in keys}


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(frame).collect()}


def test_documents_equal_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute_force(rows)


def test_threshold_chains_and_odd_rows(spark):
    words = [f"w{i}" for i in range(400)]
    near = lambda start: " ".join(words[start : start + 60])
    rows = [(10 + i, near(4 * i)) for i in range(12)]  # 52 of 60 shingles differ by shift: a chain
    rows += [(50, "A b"), (51, "a  B"), (52, ""), (53, None), (54, "x"), (55, " \t\n")]
    rows += [(60 + i, " ".join(words[300:340] + [f"q{i}"])) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == brute_force(rows)


def test_repeated_rows_missing_ids_and_extra_columns(spark):
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 0), (None, "a b c d e f", 1), (None, "other words", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    judged = near_duplicates(frame).collect()
    assert len(judged) == 4
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in judged} == {(1, 1, True), (None, 1, False), (None, None, True)}
    kept = without_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()).count(1) == 1


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_that_share_an_id_are_one_node_and_lose_no_text(spark):
    one, two, three = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(1, one), (5, one), (5, two), (7, two + " more"), (9, None), (9, three), (None, three + " more"), (None, three + " again"), (None, one + " x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    judged = {(r["doc_id"], r["component_id"]) for r in near_duplicates(frame).collect() if r["doc_id"] in (1, 5, 7)}
    assert judged == {(1, 1), (5, 1), (7, 1)}
    kept = sorted((r["doc_id"], r["text"] or "") for r in without_duplicates(frame).collect())
    assert kept == [(1, one), (5, two), (9, ""), (9, three)]
    alone = spark.createDataFrame([(None, three), (None, three + " more"), (None, one)], "doc_id long, text string")
    left = [r["text"] for r in without_duplicates(alone).collect()]
    assert len(left) == 2 and one in left
