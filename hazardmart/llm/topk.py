"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights; a term is a component. Candidates are packed into
blocks of postings, term by term, and queries into blocks of sparse rows. Every pair of blocks is one
cell: each term of the queries scatters its weighted postings into dense score arrays, the best k of
each query are selected by partition, and the cells' selections are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values of one packed block, of candidates or of queries: blocks are square, and fit a task many times over.
BLOCK_VALUES = 1 << 20
# Blocks of each side, at least, so that small tables make enough cells for several machines.
LEAST_BLOCKS = 8
# Queries whose dense scores are accumulated at a time.
QUERIES_AT_ONCE = 128


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows with an id and a vector of finite components, as ``id`` and ``vec`` (floats stay floats)."""
    single = vectors.schema[vector].dataType.elementType.simpleString() == "float"
    value = F.col(vector).cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), value.alias("vec")).filter("id IS NOT NULL")
    infinite = F.lit(float("inf"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinite))
    return rows.filter(F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(False)))


@dataclass(frozen=True)
class Postings:
    """Weights other than zero of ``count`` rows, term by term: those of ``terms[i]`` start at ``starts[i]``.

    ``rows`` and ``weights`` are stored in the narrowest type that holds them; weights beyond 64-bit
    integers stay floats, which hold them exactly.
    """

    count: int
    terms: np.ndarray
    starts: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, vectors: list[np.ndarray]) -> Postings:
        lengths = [len(vector) for vector in vectors]
        weights = np.concatenate(vectors) if vectors else np.empty(0)
        rows = np.repeat(np.arange(len(vectors)), lengths)
        terms = np.concatenate([np.arange(length) for length in lengths]) if vectors else np.empty(0, np.int64)
        order = np.lexsort((rows, terms))
        order = order[weights[order] != 0]
        present, starts = np.unique(terms[order], return_index=True)
        least = np.result_type(np.min_scalar_type(max(0, len(vectors) - 1)))
        return cls(len(vectors), present, np.append(starts, len(order)), rows[order].astype(least), narrowed(weights[order]))

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for term, start, end in zip(self.terms, self.starts, self.starts[1:], strict=False):
            yield int(term), self.rows[start:end], self.weights[start:end]

    def packed(self) -> dict[str, list]:
        parts = {"terms": self.terms.astype(np.int32), "starts": self.starts.astype(np.int32), "rows": self.rows, "weights": self.weights}
        kinds = f"{self.rows.dtype.str} {self.weights.dtype.str}"
        return {"n": [self.count], "kinds": [kinds]} | {name: [part.tobytes()] for name, part in parts.items()}

    @classmethod
    def unpacked(cls, block) -> Postings:
        of_rows, of_weights = block.kinds.split()
        terms, starts = np.frombuffer(block.terms, np.int32), np.frombuffer(block.starts, np.int32)
        return cls(block.n, terms, starts, np.frombuffer(block.rows, of_rows), np.frombuffer(block.weights, of_weights))


PACKED = "ids binary, n long, kinds string, terms binary, starts binary, rows binary, weights binary"


def narrowed(weights: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest of 16, 32 and 64 bits, or as floats beyond."""
    most = np.abs(weights).max(initial=0)
    for bits in (16, 32, 63):
        if most < 2.0 ** (bits - 1):
            return weights.astype(f"int{bits + bits % 2}")
    return weights


def _packed(rows: DataFrame, block: str) -> DataFrame:
    """One row per block: ids ascending, and the postings of their weights."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        ids = group["id"].to_numpy(np.int64).tobytes()
        return pd.DataFrame({block: [group[block].iloc[0]], "ids": [ids]} | Postings.of(list(group["weights"])).packed())

    return rows.groupBy(block).applyInPandas(pack, f"{block} long, {PACKED}")


def accumulate(candidates: Postings, queries: Postings) -> Iterator[np.ndarray]:
    """Scores of all candidates (columns) for some queries (rows) after others, term by term.

    Sums are formed in the narrowest integers that the weights prove to hold them, else in Python
    integers that stop at the limits of 64 bits.
    """
    most = 1
    for side in (candidates, queries):
        most *= int(max(side.weights.max(initial=0), -side.weights.min(initial=0)))
    most *= max(1, len(queries.terms))
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    whole = (lambda x: x.astype(kind)) if kind is not object else np.vectorize(int, otypes=[object])
    asked = {term: (rows, whole(weights)) for term, rows, weights in queries}
    shared = []
    for term, places, weights in candidates:
        if term in asked:
            weights = whole(weights)
            if 4 * len(places) > candidates.count:  # one pass over whole arrays is faster than scattering so much
                scattered = np.zeros(candidates.count, kind)
                scattered[places] = weights
                places, weights = slice(None), scattered
            shared.append((places, weights, *asked[term]))
    for first in range(0, queries.count, QUERIES_AT_ONCE):
        last = min(first + QUERIES_AT_ONCE, queries.count)
        dense = np.zeros((last - first, candidates.count), kind)
        for places, weights, query_rows, query_weights in shared:
            start, end = np.searchsorted(query_rows, [first, last])
            for query, weight in zip(query_rows[start:end].astype(np.int64) - first, query_weights[start:end], strict=True):
                dense[query, places] += weight * weights
        yield np.clip(dense, -(2**63), 2**63 - 1).astype(np.int64) if kind is object else dense


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equal ones at the end the first places stay."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def _score_cell(k: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [np.empty(0, np.int64)], "id": [np.empty(0, np.int64)], "score": [np.empty(0, np.int64)]}
        sides = {row.side: (np.frombuffer(row.ids, np.int64), Postings.unpacked(row)) for row in cell.itertuples()}
        if len(sides) == 2:
            (ids, candidates), (query_ids, queries) = sides["c"], sides["q"]
            asked = iter(query_ids)
            for dense in accumulate(candidates, queries):
                for scores in dense:
                    query_id = next(asked)
                    start, end = np.searchsorted(ids, query_id, "left"), np.searchsorted(ids, query_id, "right")
                    if start < end:
                        others = np.delete(np.arange(len(ids)), slice(start, end))
                        best = others[select(scores[others], k)]
                    else:
                        best = select(scores, k)
                    found["query_id"].append(np.full(len(best), query_id))
                    found["id"].append(ids[best])
                    found["score"].append(scores[best].astype(np.int64))
        return pd.DataFrame({name: np.concatenate(parts) for name, parts in found.items()})

    return run


def exact_top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k candidates of highest integer inner product for every query.

    Components become ``floor(scale * x)``. Rows without id, without a vector or with a null or
    non-finite component take no part; shorter vectors count as ended by zeros. Candidates that share
    the query's id are its own row; among queries of one id the smallest vector counts. Candidates of
    equal score rank by id. Without a usable row on either side the result is empty. Rows are dealt to blocks
    by id and vector, so that an id with many vectors is spread.
    """
    weights = F.transform("vec", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    offered = usable(candidates, key, vector).select("id", weights.alias("weights"))
    # Of equal rows at most k can be among the best, so that one row in many copies fills no block.
    copies = F.explode(F.array_repeat(F.lit(0), F.least(F.col("n"), F.lit(k)).cast("int")))
    offered = offered.groupBy("id", "weights").agg(F.count("*").alias("n")).select("id", "weights", copies.alias("copy"))
    asked = usable(queries, key, vector).groupBy("id").agg(F.min("vec").alias("vec"))
    asked = asked.select("id", weights.alias("weights"))
    sizes = [side.agg(F.count("*"), F.max(F.size("weights"))).first() for side in (offered, asked)]
    (n_candidates, n_queries), width = (size[0] for size in sizes), max(1, *(size[1] or 0 for size in sizes))
    candidate_blocks, query_blocks = (max(LEAST_BLOCKS, -(-n * width // BLOCK_VALUES)) for n in (n_candidates, n_queries))

    def blocks(side: DataFrame, name: str, count: int) -> DataFrame:
        return _packed(side.withColumn(name, F.pmod(F.xxhash64("id", "weights"), F.lit(count))), name)

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    packed = ["c", "q", "side", *(field.split()[0] for field in PACKED.split(", "))]
    offered = blocks(offered, "c", candidate_blocks).select("*", F.lit("c").alias("side"), numbers(query_blocks).alias("q"))
    asked = blocks(asked, "q", query_blocks).select("*", F.lit("q").alias("side"), numbers(candidate_blocks).alias("c"))
    cells = offered.select(packed).union(asked.select(packed)).groupBy("c", "q")
    scored = cells.applyInPandas(_score_cell(k), "query_id long, id long, score long")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = scored.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")


def oracle(k: int = 20, every: int = 20) -> str:
    """``exact_top_k`` over ``embeddings`` as SQL, queries being the ids divisible by ``every``."""
    return f"""
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
