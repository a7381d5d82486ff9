"""Approximate nearest neighbours by balanced posting lists.

Sampled rows are halved again and again at the median of their main direction, which gives lists of
equal size; their means are the centroids. There are as many lists as the rows fill, up to what one
in-memory graph holds: a small sample is cut into cells on the driver, and each cell's share of a
larger sample is cut into its lists by a task. Every row goes to its nearest centroid and, when it
lies on a boundary, to further ones. Centroids are found by a best-first walk over the graph; a query
reads the lists whose centroid is at most a given ratio farther than the nearest one. Lists beside each
other are bundled: a query goes to a bundle once, and leaves it with its k nearest of all its lists there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardmart.llm.topk import usable
from hazardmart.sources.landed import land

# Rows of a bundle of lists, and queries of it, that a task compares at a time.
BUNDLE_ROWS, BUNDLE_QUERIES = 8192, 2048
# Bundles, at least, so that small tables make enough of them for several machines.
LEAST_BUNDLES = 32
# Queries whose distances to a list are held at the same time.
QUERIES_AT_ONCE = 64
# Rows that walk over the graph at the same time.
ROWS_AT_ONCE = 512


@dataclass(frozen=True)
class IndexOptions:
    """``sample``: rows that the driver cuts into about ``cells``, the first by a hash of the id.

    ``list_rows``: rows per list aimed at; ``max_lists``: lists aimed at, at most, which bounds the
    broadcast graph (halving gives up to twice as many); ``sampled``: rows, at most, whose mean is a
    centroid; ``cell_rows``: sampled rows of a cell that a task cuts at a time; ``replicas`` and
    ``boundary``: how many lists a row may be in, and how much farther than the nearest centroid theirs
    may be; ``recall``: share of the true neighbours of ``trials`` sampled rows that the lists read must
    hold; ``least_probes``: lists that are read in any case; ``degree``: edges of a centroid.
    """

    sample: int = 20_000
    cells: int = 64
    list_rows: int = 128
    max_lists: int = 1 << 16
    sampled: int = 64
    cell_rows: int = 1 << 14
    replicas: int = 4
    boundary: float = 0.2
    recall: float = 0.96
    trials: int = 256
    least_probes: int = 8
    degree: int = 16
    seed: int = 11


def balanced_centroids(sample: np.ndarray, list_rows: int, seed: int) -> np.ndarray:
    """Means of equal halves of halves of the sample, down to ``list_rows`` rows."""
    random = np.random.default_rng(seed)
    waiting, centroids = [np.arange(len(sample))], []
    while waiting:
        rows = waiting.pop()
        part = sample[rows]
        if len(rows) <= list_rows:
            centroids.append(part.mean(axis=0))
            continue
        ends = part[random.choice(len(rows), 2, replace=False)]
        for _ in range(4):  # a few rounds of two means give the direction to halve along
            nearer = ((part - ends[0]) ** 2).sum(1) <= ((part - ends[1]) ** 2).sum(1)
            if nearer.all() or not nearer.any():
                break
            ends = np.stack([part[nearer].mean(axis=0), part[~nearer].mean(axis=0)])
        order = np.argsort(part @ (ends[1] - ends[0]), kind="stable")
        waiting += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return np.array(centroids)


@dataclass
class CentroidGraph:
    """Centroids, the neighbours of each, and spread-out places to start a walk from.

    Centroids beside each other in the halving follow each other. ``sizes``: different ids in the list
    of each centroid, ``bundles``: the bundle it is in; both are set once the lists are filled.
    """

    centroids: np.ndarray
    edges: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    degree: int = 16
    ratio: float = 1.0
    sizes: np.ndarray | None = None
    bundles: np.ndarray | None = None

    def __post_init__(self):
        centroids = self.centroids = np.ascontiguousarray(self.centroids, np.float32)
        self.squares = (centroids**2).sum(1)
        count = len(centroids)
        near = min(self.degree, count - 1)
        self.edges = np.zeros((count, max(near, 1)), np.int64)
        for first in range(0, count, 512):  # distances of a strip of centroids at a time
            strip = slice(first, first + 512)
            distances = self.squares - 2 * centroids[strip] @ centroids.T
            distances[np.arange(len(distances)), np.arange(first, first + len(distances))] = np.inf
            if near:
                self.edges[strip] = np.argpartition(distances, near - 1, axis=1)[:, :near]
        starts, nearest = [0], np.full(count, np.inf)
        for _ in range(min(count, 32) - 1):
            nearest = np.minimum(nearest, ((centroids - centroids[starts[-1]]) ** 2).sum(1))
            starts.append(int(nearest.argmax()))
        self.starts = np.unique(starts)

    def _distances(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Squared distances of each row to its own places, but for the row's square."""
        return self.squares[places] - 2 * np.einsum("nd,nkd->nk", rows, self.centroids[places])

    def nearest(self, rows: np.ndarray, wanted: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of about the ``wanted`` nearest centroids of each row, nearest first.

        A best-first walk for all rows at a time: each step opens the ``step`` nearest unopened
        centroids of every row and keeps the nearest of what they lead to.
        """
        rows32 = rows.astype(np.float32)
        count, wanted = len(self.centroids), min(wanted, len(self.centroids))
        line = np.arange(len(rows))[:, None]
        seen = np.zeros((len(rows), count), bool)
        seen[:, self.starts] = True
        places = np.broadcast_to(self.starts, (len(rows), len(self.starts))).copy()
        distances = self.squares[self.starts] - 2 * rows32 @ self.centroids[self.starts].T
        opened = np.zeros(places.shape, bool)
        while True:
            keep = np.argsort(distances, axis=1, kind="stable")[:, :wanted]
            places, distances, opened = places[line, keep], distances[line, keep], opened[line, keep]
            pending = np.where(opened, np.inf, distances)
            if not np.isfinite(pending).any():
                break
            chosen = np.argsort(pending, axis=1, kind="stable")[:, :step]
            opened[line, chosen] = True
            useful = np.isfinite(pending[line, chosen])
            reached = self.edges[places[line, chosen]].reshape(len(rows), -1)
            fresh = ~seen[line, reached] & np.repeat(useful, self.edges.shape[1], axis=1)
            seen[line, np.where(fresh, reached, places[:, :1])] = True
            ordered = np.sort(np.where(fresh, reached, count), axis=1)
            ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = count  # reached twice in this step
            real = ordered < count
            ordered = np.where(real, ordered, 0)
            found = np.where(real, self._distances(rows32, ordered), np.inf)
            places = np.concatenate([places, ordered], axis=1)
            distances = np.concatenate([distances, found], axis=1)
            opened = np.concatenate([opened, ~real], axis=1)
        squared = distances + (rows32**2).sum(1)[:, None]
        return places, np.sqrt(np.maximum(squared, 0))

    def posting_lists(self, rows: np.ndarray, options: IndexOptions) -> list[np.ndarray]:
        """Lists of each row: the nearest, and others whose centroid is hardly farther.

        A further list is taken only if its centroid is nearer to the row than to the centroids of
        the lists it is in already: then the row lies on a boundary, and the list is no neighbour of
        those that a query reading the others would read anyway.
        """
        places, distances = self.nearest(rows, 3 * options.replicas)
        chosen = np.zeros(places.shape, bool)
        chosen[:, 0] = True
        near = distances <= distances[:, :1] * (1 + options.boundary)
        for rank in range(1, places.shape[1]):
            apart = self.centroids[places[:, :rank]] - self.centroids[places[:, rank]][:, None]
            apart = np.sqrt((apart**2).sum(2))
            beyond = (~chosen[:, :rank] | (apart >= distances[:, rank, None])).all(1)
            chosen[:, rank] = near[:, rank] & beyond & (chosen.sum(1) < options.replicas)
        return [own[kept] for own, kept in zip(places, chosen, strict=True)]

    def probed_lists(self, rows: np.ndarray, options: IndexOptions, k: int) -> list[np.ndarray]:
        """Lists that each query reads: those within the distance ratio, and the nearest few.

        Further lists are read where these hold too few rows for k neighbours, even if every one of
        them were in as many lists as a row can be. The walk is widened until the farthest list it
        returns is not wanted.
        """
        wanted = 4 * options.least_probes
        while True:
            places, distances = self.nearest(rows, wanted, step=16)
            before = np.cumsum(self.sizes[places], axis=1) - self.sizes[places]
            within = (distances <= distances[:, :1] * self.ratio) | (before <= k * options.replicas)
            if wanted >= len(self.centroids) or not within[:, -1].any():
                break
            wanted *= 2
        within[:, : options.least_probes] = True
        within &= np.isfinite(distances)
        return [own[chosen] for own, chosen in zip(places, within, strict=True)]

    def calibrate(self, queries: np.ndarray, neighbours: list[np.ndarray], options: IndexOptions) -> None:
        """The distance ratio at which the probed lists hold enough of the queries' true neighbours."""
        needed = []
        for query, rows in zip(queries, neighbours, strict=True):
            to_lists = np.sqrt(((self.centroids - query) ** 2).sum(1))
            nearest = max(to_lists.min(), 1e-12)
            for start in range(0, len(rows), ROWS_AT_ONCE):
                lists = self.posting_lists(rows[start : start + ROWS_AT_ONCE], options)
                needed += [to_lists[own].min() / nearest for own in lists]
        self.ratio = max(1.0, float(np.quantile(needed, options.recall))) if needed else 1.0


def _stacked(vectors: pa.Array) -> np.ndarray:
    return np.stack(vectors.to_numpy(zero_copy_only=False)).astype(np.float64)


def _cell_centroids(rows: DataFrame, cells: np.ndarray, share: float, options: IndexOptions) -> np.ndarray:
    """Centroids of the lists: each cell's part of a sample of ``share`` of the rows, halved by tasks.

    Equal vectors count once. The rows of a crowded cell are cut in several parts by a hash, each of
    which gives its share of the centroids.
    """
    limit = int(share * 2**32)
    sampled = rows.filter(F.pmod(F.xxhash64("id", F.lit(options.seed + 1)), F.lit(2**32)) < limit)
    graph = CentroidGraph(cells, degree=options.degree)
    alone = replace(options, replicas=1)
    placed = land(_assigned(sampled.select("id", "vec").dropDuplicates(["vec"]), graph, alone), "cells")
    parts = placed.groupBy("list").agg(F.ceil(F.count("*") / options.cell_rows).alias("parts"))
    split = placed.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))

    def halve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", kind="stable")  # the same centroids if the task runs again
        vectors = np.stack(part["vec"].to_list()).astype(np.float64)
        found = list(balanced_centroids(vectors, options.sampled, options.seed))
        return pd.DataFrame({"list": part["list"].iloc[0], "part": part["part"].iloc[0], "place": range(len(found)), "vec": found})

    cut = split.select("list", "part", "id", "vec").groupBy("list", "part")
    found = cut.applyInPandas(halve, "list long, part long, place long, vec array<double>").toPandas()
    found = found.sort_values(["list", "part", "place"])
    return np.stack(found["vec"].to_list()) if len(found) else cells


def true_neighbours(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """Vectors of the k nearest rows of each of a few queries, found by comparing them with all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        best = [(np.empty(0), np.empty((0, queries.shape[1])))] * len(queries)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                own, vectors = batch.column("id").to_numpy(), _stacked(batch.column("vec"))
                away = (vectors**2).sum(1) - 2 * queries @ vectors.T + (queries**2).sum(1)[:, None]
                away[ids[:, None] == own] = np.inf
                for number, distances in enumerate(away):
                    far, kept = best[number]
                    if len(far) == k and not distances.min() < far.max():
                        continue
                    far = np.concatenate([far, distances])
                    keep = np.argsort(far, kind="stable")[:k]
                    keep = keep[np.isfinite(far[keep])]
                    best[number] = far[keep], np.concatenate([kept, vectors])[keep]
        counts = [len(far) for far, _ in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(queries)), counts), pa.int64()),
                pa.array(np.concatenate([far for far, _ in best]), pa.float64()),
                pa.array([row for _, kept in best for row in kept.tolist()], pa.list_(pa.float64())),
            ],
            names=["query", "away", "vec"],
        )

    found = rows.select("id", "vec").mapInArrow(run, "query long, away double, vec array<double>")
    nearest_first = Window.partitionBy("query").orderBy("away", "vec")
    found = found.withColumn("place", F.row_number().over(nearest_first)).filter(F.col("place") <= k)
    found = found.select("query", "vec").toPandas()
    vectors = dict(list(found.groupby("query")["vec"]))
    none = np.empty((0, queries.shape[1]))
    return [np.stack(vectors[number].to_list()) if number in vectors else none for number in range(len(queries))]


def fit(rows: DataFrame, count: int, k: int, options: IndexOptions) -> CentroidGraph:
    """Centroid graph of ``count`` rows, with the ratio that finds the true neighbours of sampled rows."""
    order = F.xxhash64(F.col("id"), F.lit(options.seed))
    sample = rows.orderBy(order, "id").limit(options.sample).toPandas()
    ids, vectors = sample["id"].to_numpy(), np.stack(sample["vec"].to_list()).astype(np.float64)
    distinct = np.unique(vectors, axis=0)
    cells = balanced_centroids(distinct, max(options.list_rows, -(-len(distinct) // options.cells)), options.seed)
    lists = min(options.max_lists, -(-count // options.list_rows))
    share = min(1.0, lists * options.sampled / count)
    graph = CentroidGraph(_cell_centroids(rows, cells, share, options), degree=options.degree)
    queries = vectors[: options.trials]
    graph.calibrate(queries, true_neighbours(rows, ids[: options.trials], queries, k), options)
    return graph


def _assigned(rows: DataFrame, graph: CentroidGraph, options: IndexOptions) -> DataFrame:
    """One row per list of each row: (list, id, vec)."""
    shared = rows.sparkSession.sparkContext.broadcast(graph)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                lists = graph.posting_lists(_stacked(batch.column("vec")), options)
                repeated = pa.array(np.repeat(np.arange(len(lists)), [len(found) for found in lists]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists), pa.int64()), batch.column("id").take(repeated), batch.column("vec").take(repeated)],
                    names=["list", "id", "vec"],
                )

    return rows.mapInArrow(run, f"list long, id long, vec {rows.schema['vec'].dataType.simpleString()}")


def _probed(queries: DataFrame, graph: CentroidGraph, options: IndexOptions, k: int) -> DataFrame:
    """One row per bundle that a query reads, with the lists there: (bundle, id, vec, lists)."""
    shared = queries.sparkSession.sparkContext.broadcast(graph)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                bundles, repeated, lists = [], [], []
                for number, own in enumerate(graph.probed_lists(_stacked(batch.column("vec")), options, k)):
                    own = np.sort(own)  # bundles are runs of lists
                    read, firsts = np.unique(graph.bundles[own], return_index=True)
                    bundles += read.tolist()
                    repeated += [number] * len(read)
                    lists += [part.tolist() for part in np.split(own, firsts[1:])]
                repeated = pa.array(repeated, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bundles, pa.int64()), batch.column("id").take(repeated), batch.column("vec").take(repeated),
                        pa.array(lists, pa.list_(pa.int64())),
                    ],
                    names=["bundle", "id", "vec", "lists"],
                )

    kind = queries.schema["vec"].dataType.simpleString()
    return queries.mapInArrow(run, f"bundle long, id long, vec {kind}, lists array<long>")


def _compare(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [np.empty(0, np.int64)], "id": [np.empty(0, np.int64)], "score": [np.empty(0)]}
        if len(queries) and len(rows):
            rows = rows.sort_values("id", kind="stable")
            all_ids, vectors = rows["id"].to_numpy(), np.stack(rows["vec"].to_list()).astype(np.float64)
            lists, place = np.unique(rows["list"].to_numpy(), return_inverse=True)
            # Queries that read the same lists come together, so that other lists' rows are not touched.
            queries = queries.assign(first=[own[0] for own in queries["lists"]]).sort_values(["first", "id"], kind="stable")
            all_asked, points = queries["id"].to_numpy(), np.stack(queries["vec"].to_list()).astype(np.float64)
            read = np.stack([np.isin(lists, own) for own in queries["lists"]])
            for start in range(0, len(all_asked), QUERIES_AT_ONCE):
                strip = slice(start, start + QUERIES_AT_ONCE)
                some = np.flatnonzero(read[strip].any(axis=0)[place])
                if not len(some):
                    continue
                ids, own_vectors, own_read = all_ids[some], vectors[some], read[strip][:, place[some]]
                possible = _possible(own_vectors, ids, points[strip], all_asked[strip], own_read, k)
                for query_id, point, near in zip(all_asked[strip], points[strip], possible, strict=True):
                    distances = np.sqrt(((own_vectors[near] - point) ** 2).sum(axis=1))
                    near, distances = near[np.isfinite(distances)], distances[np.isfinite(distances)]
                    order = np.lexsort((ids[near], distances))
                    _, firsts = np.unique(ids[near[order]], return_index=True)  # an id counts by its nearest row
                    order = order[np.sort(firsts)[:k]]
                    found["query_id"].append(np.full(len(order), query_id))
                    found["id"].append(ids[near[order]])
                    found["score"].append(distances[order])
        return pd.DataFrame({name: np.concatenate(parts) for name, parts in found.items()})

    return run


def _possible(
    vectors: np.ndarray, ids: np.ndarray, points: np.ndarray, asked: np.ndarray, read: np.ndarray, k: int
) -> Iterator[np.ndarray]:
    """Rows read that can be among the k nearest ids of each query, by distances from one matrix product.

    Their rounding is far below the slack, so that no row which the exact distances put first is left out.
    """
    squares, own = (vectors**2).sum(1), (points**2).sum(1)
    away = squares - 2 * points @ vectors.T + own[:, None]
    read = read & (asked[:, None] != ids)
    away[~read] = np.inf
    slack = 1e-9 * (own + squares.max())
    firsts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    by_id = away if len(firsts) == len(ids) else np.minimum.reduceat(away, firsts, axis=1)
    limits = np.full(len(points), np.inf) if len(firsts) <= k else np.partition(by_id, k - 1, axis=1)[:, k - 1] + slack
    for distances, limit, own in zip(away, limits, read, strict=True):
        yield np.flatnonzero(~(distances > limit) & own)


def bundled(rows: np.ndarray, wanted: int) -> np.ndarray:
    """Numbers of runs of lists that hold about ``wanted`` rows each; a larger list ends its run."""
    return (np.cumsum(rows) - rows) // max(1, wanted)


def assigned(offered: DataFrame, asked: DataFrame, count: int, k: int, options: IndexOptions) -> tuple[DataFrame, DataFrame]:
    """What is compared of ``count`` offered rows and of the queries.

    Rows come as (list, id, vec, bundle, row_parts), the latter being the parts of the bundle; queries
    as (bundle, id, vec, lists).
    """
    graph = fit(offered, count, k, options)
    postings = land(_assigned(offered, graph, options), "postings")
    held = postings.groupBy("list").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids")).toPandas()
    graph.sizes, rows = (np.zeros(len(graph.centroids), np.int64) for _ in range(2))
    graph.sizes[held["list"]], rows[held["list"]] = held["ids"], held["rows"]
    graph.bundles = bundled(rows, min(BUNDLE_ROWS, -(-count // LEAST_BUNDLES)))
    parts = -(-np.bincount(graph.bundles, weights=rows).astype(np.int64) // BUNDLE_ROWS)
    # A row per centroid, at most, like the counts above.
    places = pd.DataFrame({"list": np.arange(len(rows)), "bundle": graph.bundles, "row_parts": np.maximum(1, parts)[graph.bundles]})
    places = offered.sparkSession.createDataFrame(pa.Table.from_pandas(places, preserve_index=False))
    return postings.join(places, "list"), land(_probed(asked, graph, options, k), "probes")


def rows_compared(postings: DataFrame, probes: DataFrame) -> DataFrame:
    """Per query: how many rows of its lists it is compared with (``id``, ``rows``)."""
    sizes = postings.groupBy("list").agg(F.count("*").alias("rows"))
    return probes.select("id", F.explode("lists").alias("list")).join(sizes, "list").groupBy("id").agg(F.sum("rows").alias("rows"))


def nearest_neighbours(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 10,
    options: IndexOptions = IndexOptions(),
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k nearest candidates found for every query, by Euclidean distance in double precision.

    Rows without id, with a null or zero vector or with a null or non-finite component take no part;
    shorter vectors count as ended by zeros. Candidates that share the query's id are its own row;
    rows that share an id count once, by their nearest vector. Equally near ones rank by id. Without
    a usable row on either side the result is empty. Hot lists are split over tasks.
    """
    nonzero = F.exists("vec", lambda x: x != 0)
    offered = usable(candidates, key, vector).filter(nonzero)
    asked = usable(queries, key, vector).filter(nonzero).groupBy("id").agg(F.min("vec").alias("vec"))
    (count, width), longest = offered.agg(F.count("*"), F.max(F.size("vec"))).first(), asked.agg(F.max(F.size("vec"))).first()[0]
    width = max(width or 0, longest or 0)
    kind = offered.schema["vec"].dataType.elementType.simpleString()
    missing = F.array_repeat(F.lit(0).cast(kind), F.greatest(F.lit(width) - F.size("vec"), F.lit(0)))
    padded = F.concat("vec", missing)
    offered, asked = offered.select("id", padded.alias("vec")), asked.select("id", padded.alias("vec"))
    if not count or longest is None:
        empty = "query_id long, rank int, id long, score double"
        return candidates.sparkSession.createDataFrame([], empty).withColumnRenamed("id", key)
    postings, probes = assigned(offered, asked, count, k, options)
    probed = probes.groupBy("bundle").agg(F.ceil(F.count("*") / BUNDLE_QUERIES).alias("query_parts"))
    # At most one row per centroid: which bundles are read, and in how many parts.
    parts = land(postings.groupBy("bundle").agg(F.max("row_parts").alias("row_parts")).join(probed, "bundle"), "parts")

    def cells(rows: DataFrame, own: str, other: str, *columns: str) -> DataFrame:
        split = rows.drop("row_parts").join(parts, "bundle").withColumn(own, F.pmod(F.xxhash64("id", "vec"), F.col(f"{own}s")))
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)).alias(other)
        return split.select("bundle", own, others, *columns).groupBy("bundle", "row_part", "query_part")

    near = (
        cells(probes, "query_part", "row_part", "id", "vec", "lists")
        .cogroup(cells(postings, "row_part", "query_part", "list", "id", "vec"))
        .applyInPandas(_compare(k), "query_id long, id long, score double")
    )
    once = near.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    nearest_first = Window.partitionBy("query_id").orderBy("score", "id")
    ranked = once.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
