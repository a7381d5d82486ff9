"""Vector searches against brute force."""

import numpy as np
import pytest

from hazardmart.llm.common import read
from pyspark.sql import functions as F

from hazardmart.llm.neighbours import CentroidGraph, IndexOptions, assigned, nearest_neighbours, rows_compared
from hazardmart.llm.topk import exact_top_k, usable

SCHEMA = "vec_id long, embedding array<double>"


def odd_rows():
    return [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None]),
        (6, [0.0, 0.0]), (7, [float("inf"), 0.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]),
    ]


@pytest.mark.parametrize("options", [IndexOptions(), IndexOptions(sample=1000, list_rows=32)], ids=["registered", "small sample"])
def test_recall_and_scores(spark, options):
    vectors = read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in vectors.collect()}
    ids, matrix = np.array(sorted(rows)), np.stack([rows[i] for i in sorted(rows)])
    result = nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), options=options).collect()
    hits = 0
    for query in (i for i in ids if i % 100 == 0):
        away = np.sqrt(((matrix - rows[query]) ** 2).sum(axis=1))
        away[ids == query] = np.inf
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in result if r["query_id"] == query)
        assert [rank for rank, _, _ in own] == [*range(1, 11)]
        assert all(abs(score - away[ids == found][0]) < 1e-12 for _, found, score in own)
        hits += len({found for _, found, _ in own} & set(ids[np.lexsort((ids, away))[:10]]))
    assert hits / (10 * sum(ids % 100 == 0)) >= 0.9


def test_neighbours_of_odd_rows(spark):
    frame = spark.createDataFrame(odd_rows(), SCHEMA)
    result = nearest_neighbours(frame, frame.filter("vec_id IN (0, 3, 6)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(result, key=lambda r: r["rank"])] == [
        (0, 1, 1, 0.0), (0, 2, 8, 0.0), (0, 3, 2, 0.5)
    ]


def test_top_k_of_odd_rows_and_large_weights(spark):
    frame = spark.createDataFrame([*odd_rows(), (9, [1e12, 0.0])], SCHEMA)
    result = exact_top_k(frame, frame.filter("vec_id IN (0, 9)"), k=4).collect()
    own = {q: [(r["vec_id"], r["score"]) for r in sorted(result, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 9)}
    assert own[0] == [(9, 64 * 64 * 10**12), (1, 4096), (8, 4096), (8, 4096)]
    assert own[9] == [(0, 64 * 64 * 10**12), (1, 64 * 64 * 10**12), (8, 64 * 64 * 10**12), (8, 64 * 64 * 10**12)]


def test_empty_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert exact_top_k(frame, frame).collect() == []
    assert nearest_neighbours(frame, frame).collect() == []


def test_repeated_ids_take_one_place(spark):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(60, 4))
    far = vectors + 50.0
    order = np.argsort(((vectors - vectors[0]) ** 2).sum(axis=1))
    rows = [(i, vectors[i].tolist()) for i in range(60)]
    rows += [(int(order[1]), vectors[order[1]].tolist())] * 15  # more copies than k
    rows += [(i, vectors[i].tolist()) for i in range(60)] + [(int(order[2]), far[order[2]].tolist())] * 3
    frame = spark.createDataFrame(rows, SCHEMA)
    result = sorted(nearest_neighbours(frame, frame.filter("vec_id = 0")).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r["vec_id"]) for r in result] == [(rank, int(order[rank])) for rank in range(1, 11)]


def clustered(spark, n, seed=3):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(40, 16))
    vectors = middles[random.integers(0, 40, n)] + 0.2 * random.normal(size=(n, 16))
    return vectors, spark.createDataFrame(list(enumerate(vectors.tolist())), SCHEMA).repartition(4)


def test_lists_grow_with_the_rows_and_queries_read_few_of_them(spark):
    lists = []
    for n in (2000, 8000):
        vectors, frame = clustered(spark, n)
        offered = usable(frame, "vec_id", "embedding")
        asked = offered.filter("id % 20 = 0")
        postings, probes = assigned(offered, asked, n, 10, IndexOptions())
        compared = rows_compared(postings, probes).agg(F.count("*"), F.avg("rows")).first()
        assert compared[0] == n // 20 and compared[1] < 0.5 * n
        assert postings.select("id").distinct().count() == n
        assert postings.agg(F.countDistinct("bundle")).first()[0] >= 8
        lists.append(postings.select("list").distinct().count())
        result = nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"))
        found = {}
        for row in result.collect():
            found.setdefault(row["query_id"], set()).add(row["vec_id"])
        hits = 0
        for query, own in found.items():
            away = ((vectors - vectors[query]) ** 2).sum(axis=1)
            away[query] = np.inf
            hits += len(own & set(np.argsort(away)[:10]))
        assert len(found) == n // 20 and hits / (10 * len(found)) >= 0.9
    assert lists[1] >= 3 * lists[0]


def test_further_lists_only_on_a_boundary():
    graph = CentroidGraph(np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [0.4, 0.0]]))
    own, middle = graph.posting_lists(np.array([[0.1, 0.0], [5.1, 0.0]]), IndexOptions())
    assert own.tolist() == [0]
    assert sorted(middle.tolist()) == [1, 3]  # not list 0, whose centroid is beside that of list 3


def test_equal_vectors_and_equal_distances(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    result = sorted(nearest_neighbours(frame, frame.filter("vec_id IN (0, 300)"), k=4).collect(), key=lambda r: (r["query_id"], r["rank"]))
    assert [(r["query_id"], r["vec_id"]) for r in result] == [(0, i) for i in (3, 6, 9, 12)] + [(300, i) for i in (0, 3, 6, 9)]


def test_top_k_of_sparse_repeated_and_crowded_rows(spark):
    random = np.random.default_rng(5)
    vectors = np.where(random.random((400, 12)) < 0.3, random.normal(size=(400, 12)), 0.0)
    ids = np.where(np.arange(400) < 150, 7, np.arange(400))  # one id holds a third of the rows
    rows = [(int(i), vector.tolist()) for i, vector in zip(ids, vectors, strict=True)]
    rows += [(399, vectors[399].tolist())] * 300  # and one row is there many times
    frame = spark.createDataFrame(rows, SCHEMA)
    result = exact_top_k(frame, frame.filter("vec_id % 20 = 0 OR vec_id = 7"), k=5).collect()
    weights = [(i, np.floor(64 * np.array(vector)).astype(int), vector) for i, vector in rows]
    for query in sorted({i for i, *_ in weights if i % 20 == 0 or i == 7}):
        asked = min((vector, tuple(w)) for i, w, vector in weights if i == query)[1]
        scored = sorted((-int(w @ np.array(asked)), i) for i, w, _ in weights if i != query)[:5]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in result if r["query_id"] == query)
        assert own == [(rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]
