"""Exact token counts at every prefix of a text, by dynamic programming over its pieces.

The encoding of a prefix ends in exactly one token that may follow the encoding of what precedes
it, so the counts of all prefixes of a piece come from one pass over its bytes. The counts of a
whole text are kept as one signed byte per character (the change of the count), from which length,
budget and truncation questions are answered without encoding anything again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.byte_bpe import CONTRACTIONS, ByteBpe, default_tokenizer, load
from hazardmart.llm.common import BoundedCache, extended, slices, texts

# The last space of such a run belongs to the next piece, but not while the prefix ends in the run.
SPLIT_RUNS = re.compile(r"\s{2,}(?=\S)")


class PrefixCounter:
    """Token counts of all prefixes of texts under one vocabulary."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        self.changes = BoundedCache(self._changes)

    def _changes(self, piece: str) -> bytes:
        """Change of the token count with each character of a piece."""
        data = piece.encode()
        _, counts = self.bpe.prefix_ends(data)
        if len(data) > len(piece):
            ends = accumulate((len(char.encode()) for char in piece), initial=0)
            counts = [counts[end] for end in ends]
        if piece in CONTRACTIONS:  # cut short, the quote and the letter are pieces of their own
            counts[2] = 2
        return bytes([(after - count) & 0xFF for count, after in zip(counts, counts[1:], strict=False)])

    def _segment(self, segment: str) -> np.ndarray:
        joined = b"".join(map(self.changes.__getitem__, self.bpe.pieces(segment)))
        changes = np.frombuffer(joined, np.int8)
        runs = [match.span() for match in SPLIT_RUNS.finditer(segment)]
        if runs:
            changes = changes.copy()
        for start, end in runs:
            last = np.frombuffer(self.changes[segment[start:end]], np.int8)[-1]
            changes[end] += changes[end - 1] - last
            changes[end - 1] = last
        return changes

    def table(self, text: str) -> np.ndarray:
        """Change of the token count with each character of a text."""
        parts = []
        for segment, special in self.bpe.segments(text):
            if special is None:
                parts.append(self._segment(segment))
                continue
            changes = self._segment(segment + special[:-1])
            inside = int(changes[len(segment) :].sum())
            parts += [changes, np.array([1 - inside], np.int8)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(load(path))


def count_of(table: np.ndarray) -> int:
    """Tokens of the whole text."""
    return int(table.sum(dtype=np.int64))


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    within = np.flatnonzero(np.cumsum(table, dtype=np.int64) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def prefix_tables(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "") -> DataFrame:
    """Per row: key, UTF-8 length, token count and the table of all prefixes.

    Null counts as the empty text, whose table is empty; repeated rows give repeated results and
    other columns are not read. ``prefix_changes`` holds one signed byte per character.
    """
    path = tokenizer or default_tokenizer()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = counter(path)
        for batch in slices(batches):
            rows = texts(batch)
            found = [tables.table(text) for text in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "n_bytes": pa.array([len(text.encode()) for text in rows], pa.int64()),
                    "n_tokens": pa.array(map(count_of, found), pa.int64()),
                    "prefix_changes": pa.array([table.tobytes() for table in found], pa.binary()),
                }
            )

    named = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {named.schema['key'].dataType.simpleString()}, n_bytes long, n_tokens long, prefix_changes binary"
    return named.mapInArrow(build, schema).withColumnRenamed("key", key)


def within_budget(tables: DataFrame, budget: int, name: str = "prefix_chars") -> DataFrame:
    """Adds the length in characters of the longest prefix of at most ``budget`` tokens.

    Reads the stored tables only; every prefix of an empty text fits any budget, at length 0.
    """
    kept = tables.drop(name)
    names, schema = kept.columns, extended(kept, **{name: "long"})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stored = batch.column("prefix_changes").to_pylist()
            fits = [longest_prefix(np.frombuffer(table or b"", np.int8), budget) for table in stored]
            columns = [*batch.columns, pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, name])

    return kept.mapInArrow(answer, schema)


def count_tokens(docs: DataFrame, limit: int = 512, tokenizer: str = "") -> DataFrame:
    """Token count of every document, whether it exceeds ``limit``, and the prefix that fits."""
    tables = within_budget(prefix_tables(docs, tokenizer=tokenizer), limit)
    return tables.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        "prefix_chars",
    )
