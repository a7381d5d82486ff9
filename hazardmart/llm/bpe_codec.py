"""BPE encoding and decoding with forced boundaries.

Two bytes that stand side by side in no vocabulary token can never be merged, whatever surrounds
them. Pieces are cut at all such places, the fragments are encoded independently of each other, and
the ids are concatenated.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.byte_bpe import ByteBpe, default_tokenizer, load
from hazardmart.llm.common import BoundedCache, extended, slices, spare, texts

ID_BYTES = np.dtype("<u4")


class BoundaryCodec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        joined = bytearray(1 << 16)
        for token in bpe.ids:
            for left, right in zip(token, token[1:], strict=False):
                joined[left << 8 | right] = 1
        #: Whether a byte (high) and the next one (low) stand side by side in any token.
        self.joined = bytes(joined)
        self.tokens = [bpe.token.get(number, b"") for number in range(max(bpe.token) + 1)]
        self.fragments = BoundedCache(self._fragment)
        self.piece_ids = BoundedCache(self._piece)
        self.special = {text: struct.pack("<I", i) for text, i in bpe.special.items()}

    def _fragment(self, data: bytes) -> bytes:
        last, _ = self.bpe.prefix_ends(data)
        ids, end = [], len(data)
        while end:
            ids.append(last[end])
            end -= len(self.tokens[last[end]])
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def cut(self, data: bytes) -> list[bytes]:
        """Fragments between forced boundaries."""
        joined = self.joined
        edges = [0]
        for place in range(1, len(data)):
            if not joined[data[place - 1] << 8 | data[place]]:
                edges.append(place)
        if len(edges) == 1:
            return [data]
        return [data[start:end] for start, end in zip(edges, [*edges[1:], len(data)], strict=True)]

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.fragments.__getitem__, self.cut(piece.encode())))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        parts = []
        for segment, special in self.bpe.segments(text):
            parts += map(self.piece_ids.__getitem__, self.bpe.pieces(segment))
            if special is not None:
                parts.append(self.special[special])
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        tokens = map(self.tokens.__getitem__, np.frombuffer(ids, ID_BYTES).tolist())
        return b"".join(tokens).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BoundaryCodec:
    return BoundaryCodec(load(path))


def _without(frame: DataFrame, names: set[str]) -> list[str]:
    return [name for name in frame.columns if name.lower() not in names]


def encode(docs: DataFrame, text: str = "text", tokenizer: str = "") -> DataFrame:
    """The rows without their text, with ``n_tokens`` and ``token_ids`` (little-endian uint32).

    Null is encoded as the empty text (no ids). Columns called like the new ones are replaced,
    repeated rows give repeated results.
    """
    path = tokenizer or default_tokenizer()
    kept = docs.select(*_without(docs, {text.lower(), "n_tokens", "token_ids"}))
    schema = extended(kept, n_tokens="long", token_ids="binary")
    names, whole = kept.columns, spare(docs, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches):
            ids = [coder.encode(row) for row in texts(batch, whole)]
            lengths = pa.array([len(row) // ID_BYTES.itemsize for row in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), lengths, pa.array(ids, pa.binary())],
                names=[*names, "n_tokens", "token_ids"],
            )

    return docs.select(*names, F.col(text).cast("string").alias(whole)).mapInArrow(run, schema)


def decode(encoded: DataFrame, text: str = "text", tokenizer: str = "") -> DataFrame:
    """The rows without their ids, with the decoded ``text``; null ids give the empty text."""
    path = tokenizer or default_tokenizer()
    kept = encoded.select(*_without(encoded, {text.lower(), "token_ids"}))
    schema = extended(kept, **{text: "string"})
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches):
            decoded = [coder.decode(ids or b"") for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(decoded, pa.string())], names=[*names, text]
            )

    return encoded.select(*names, "token_ids").mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, tokenizer: str = "") -> DataFrame:
    """Digests of every document's ids and of the text decoded from them.

    The ids stay inside the task: encoding, decoding and hashing are one pass over the rows.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches):
            ids = [coder.encode(text) for text in texts(batch)]
            decoded = (coder.decode(row).encode() for row in ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([len(row) // ID_BYTES.itemsize for row in ids], pa.int64()),
                    "ids_sha256": pa.array([sha256(row).hexdigest() for row in ids]),
                    "decoded_sha256": pa.array([sha256(row).hexdigest() for row in decoded]),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
