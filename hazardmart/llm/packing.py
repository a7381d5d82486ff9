"""Best-fit packing of documents into sequences, planned on a histogram of lengths.

Documents become token ids and are cut into pieces no longer than a sequence. Only the number of
pieces of each length reaches the driver, where best fit decreasing runs over counts: one step
places all pieces of a length into a range of sequences with the same space left. Each piece then
takes its planned slot by its rank within its length, so no document is looked at twice.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardmart.llm.common import extended, slices, texts
from hazardmart.llm.word_bpe import TextEncoder, has_ranks, word_tokenizer
from hazardmart.sources.landed import land

@dataclass(frozen=True)
class PackOptions:
    """``capacity``: tokens of a sequence; ``separator``: the id that ends each document.

    ``tokenizer``: a tokenizers file, the public word vocabulary if None. ``remembered``: words whose
    ids a task keeps at most, besides those of the texts at hand.
    """

    capacity: int = 2048
    separator: int = 0
    tokenizer: str | None = None
    remembered: int = 300_000


def pieces(docs: DataFrame, options: PackOptions = PackOptions()) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids, and its task and place among the task's pieces of that length."""

    path = options.tokenizer or word_tokenizer()
    by_ranks = has_ranks(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = TextEncoder(path, by_ranks, options.remembered), np.array([options.separator], "<u4").tobytes()
        task, width = TaskContext.get().partitionId(), 4 * options.capacity
        placed = np.zeros(options.capacity + 1, np.int64)
        for batch in slices(batches):
            owners, numbers, ids, places = [], [], [], []
            for doc, whole in zip(batch.column("doc_id").to_pylist(), encode(texts(batch)), strict=True):
                whole += end
                for number in range(-(-len(whole) // width)):
                    part = whole[number * width : (number + 1) * width]
                    owners.append(doc)
                    numbers.append(number)
                    ids.append(part)
                    places.append(placed[len(part) // 4])
                    placed[len(part) // 4] += 1
            number = np.array(numbers, np.int64)
            columns = {
                "doc_id": pa.array(owners, pa.int64()),
                "piece": pa.array(number, pa.int32()),
                "start": pa.array(number * options.capacity),
                "length": pa.array([len(part) // 4 for part in ids], pa.int64()),
                "ids": pa.array(ids, pa.binary()),
                "task": pa.array(np.full(len(ids), task), pa.int32()),
                "place": pa.array(places, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, task int, place long")


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit decreasing over counts, as rows (length, rank, sequence, stacked, offset).

    The pieces of a length from ``rank`` on go to the sequences from ``sequence`` on, ``stacked`` to
    each, the first at ``offset``; the row ends where the next one of that length begins. A length
    fills a range of sequences alike and splits at most two, and what a range has left then is less
    than half of what it had. So there are at most 3 * capacity ranges and
    3 * capacity * log2(capacity) rows, however many pieces there are.
    """
    ranges: dict[int, list[tuple[int, int]]] = {}  # space left: (first sequence, sequences)
    spaces: list[int] = []  # the keys of ``ranges``, ascending
    opened, rows = 0, []

    def put(space: int, first: int, count: int) -> None:
        if count:
            if space not in ranges:
                insort(spaces, space)
            ranges.setdefault(space, []).append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = ranges[space].pop()
                if not ranges[space]:
                    del ranges[space], spaces[at]
            else:
                space, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            stacked = space // length
            full = min(count, left // stacked)
            rest = left - full * stacked if full < count else 0
            rows.append((length, rank, first, stacked, capacity - space))
            rank, left = rank + full * stacked + rest, left - full * stacked - rest
            put(space - stacked * length, first, full)
            if rest:
                put(space - rest * length, first + full, 1)
            put(space, first + full + (rest > 0), count - full - (rest > 0))
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, options: PackOptions = PackOptions(), keep_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    A document is the ids of its whole text (null: empty) and the separator; only documents longer
    than a sequence are cut. Rows are packed one by one, whatever their doc_id: a repeated or missing
    one does not matter, and other columns are not read. Sequences are numbered from 0 and hold their
    pieces without gaps. An empty table gives an empty result.

    Pieces are written once with the task that made them and their place in it. What each task counted
    per length is small, and a piece's rank is its place plus the counts of lower tasks, so a length
    that a third of all documents share is never brought together.
    """
    made = land(pieces(docs, options), "pieces")
    counted = made.groupBy("task", "length").agg(F.count("*").alias("n"))
    lower = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below")
    counted = land(counted.select("task", "length", "n", below), "lengths")
    # At most ``capacity`` rows.
    lengths = {row["length"]: row["n"] for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(plan(lengths, options.capacity))

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = made.withColumn("ids_crc32", F.crc32("ids")).join(counted.drop("n"), ["task", "length"])
    ranked = ranked.select(*kept, (F.col("place") + F.col("below")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planned = shared.value
        starts = _slot(planned[:, 0], planned[:, 1])
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            _, first, sequence, stacked, offset = planned[np.searchsorted(starts, _slot(length, rank), side="right") - 1].T
            beyond = rank - first
            slots = sequence + beyond // stacked, offset + beyond % stacked * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, slots)], names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(place, extended(ranked.drop("rank"), sequence_id="long", offset="long"))


def _slot(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Length and rank as one sortable number."""
    return (length << 48) + rank


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence: sequence_id, n_tokens, ids (all pieces' one after another) and its documents' ids in order.

    ``packed`` is the result of :func:`pack` with ids. A sequence's pieces together are no longer than its
    capacity, which bounds each group.
    """
    own = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    grouped = packed.groupBy("sequence_id").agg(own.alias("own"))
    return grouped.select(
        "sequence_id",
        F.aggregate("own", F.lit(0).cast("long"), lambda so_far, part: so_far + part["length"]).alias("n_tokens"),
        F.aggregate("own", F.lit(b""), lambda so_far, part: F.concat(so_far, part["ids"])).alias("ids"),
        F.col("own.doc_id").alias("doc_ids"),
    )
