"""Reading tables and walking Arrow batches in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardmart.sources.landed import land

# Texts held as Python strings at the same time; the rest of a batch stays in Arrow buffers.
ROWS_AT_ONCE = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices short enough to turn into Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column with null as the empty text."""
    return [text or "" for text in batch.column(name).to_pylist()]


def extended(frame: DataFrame, **kinds: str) -> StructType:
    """The schema of ``frame`` with further columns of the named types."""
    added = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
    return StructType([*frame.schema.fields, *added.fields])


class BoundedCache(dict):
    """Values computed on first use; emptied at ``entries``, so that a worker's memory stays bounded."""

    def __init__(self, compute, entries: int = 400_000, longest: int = 64):
        super().__init__()
        self.compute, self.entries, self.longest = compute, entries, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value


def word_hashes() -> BoundedCache:
    """64-bit hashes of words, as strings (in UTF-8) or as bytes; about 10 MB at most."""
    return BoundedCache(xxhash.xxh3_64_intdigest, entries=60_000)


def spare(frame: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``frame`` has a column so called."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_score(docs: DataFrame, name: str, scorer: Callable[[], Callable[[str], float]]) -> DataFrame:
    """The rows with a score of their whole text (null: empty) as column ``name``.

    ``scorer`` is called once per task and gives the function from text to score.
    """
    kept = docs.drop(name)
    names, schema = kept.columns, extended(kept, **{name: "double"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in slices(batches):
            scores = pa.array(map(score, texts(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*names, name])

    return kept.mapInArrow(run, schema)


def sampled_labels(labels: DataFrame, label: str, usable: Column, sample: int) -> DataFrame:
    """About ``sample`` labelled ids, one row each, with ``label``; all if there are no more.

    They are chosen by a hash of the id; the largest label counts where an id has several. They are
    written, so that a join with the documents broadcasts them if, and only if, the file is small.
    """
    rows = labels.filter(usable & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    share = min(1.0, sample / max(rows.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000)
    return land(rows.filter(drawn), "labels")


def judged(scored: DataFrame, parts: int, remainder: int, threshold: float) -> DataFrame:
    """doc_id, held_out, score and predicted of scored rows."""
    key = F.col("doc_id")
    return scored.select(
        key,
        F.coalesce(held_out_remainder(key, parts) == remainder, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def held_out_remainder(key: Column, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def hash_sequence(values: np.ndarray, size: int, gaps: tuple[int, ...] = ()) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` values, or of values at offsets ``gaps``."""
    offsets = gaps or tuple(range(size))
    count = len(values) - offsets[-1]
    if count <= 0:
        return np.empty(0, np.uint64)
    mixed = np.zeros(count, np.uint64)
    for place, offset in enumerate(offsets):
        part = values[offset : offset + count] + np.uint64(place * 0x9E3779B97F4A7C15 % 2**64)
        mixed = (mixed ^ part) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
    return mixed
