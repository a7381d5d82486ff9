"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and the L1 term keeps weights of features that say
little at exactly zero, so the model is a short list of weights that is broadcast to the scoring
tasks. Learning sees a bounded sample of labelled rows; scoring sees every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.common import (
    BoundedCache,
    hash_sequence,
    judged,
    held_out_remainder,
    sampled_labels,
    slices,
    spare,
    texts,
    with_score,
    word_hashes,
)

WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityOptions:
    """``sample``: labelled rows to learn from, about, chosen by a hash of their id.

    ``bits``: size of the hashed feature space; ``alpha``, ``beta``, ``l1``, ``l2``: the usual
    FTRL-proximal parameters; ``epochs``: passes over the sample; ``threshold``: least score of a
    toxic document.
    """

    sample: int = 12_000
    bits: int = 20
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.1
    epochs: int = 6
    threshold: float = 0.7


@cache
def _words() -> BoundedCache:
    return word_hashes()


def feature_hashes(text: str, bits: int) -> tuple[np.ndarray, int]:
    """Hashed words, pairs of words, and pairs with one word between; and the number of words."""
    words = WORDS.findall(text.lower())
    values = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    grams = [hash_sequence(values, 1), hash_sequence(values, 2), hash_sequence(values, 2, (0, 2)) ^ np.uint64(2**63)]
    return (np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int64), len(words)


def weigh(counts: np.ndarray, n_words: int) -> np.ndarray:
    """Feature values: growing with the share of the text, ever more slowly, up to a bound."""
    return np.minimum(np.log1p(100.0 * counts / max(n_words, 1)), 1.5)


class FtrlProximal:
    """Logistic regression whose last coordinate is the bias."""

    def __init__(self, options: ToxicityOptions):
        self.options = options
        self.z = np.zeros((1 << options.bits) + 1)
        self.n = np.zeros((1 << options.bits) + 1)

    def weights(self, places: np.ndarray | slice = slice(None)) -> np.ndarray:
        o, z = self.options, self.z[places]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - o.l1, 0)
        return -shrunk / ((o.beta + np.sqrt(self.n[places])) / o.alpha + o.l2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(places)
        gradient = (sigmoid(float(weights @ values)) - label) * values
        squares = self.n[places]
        rate_change = (np.sqrt(squares + gradient**2) - np.sqrt(squares)) / self.options.alpha
        self.z[places] += gradient - rate_change * weights
        self.n[places] = squares + gradient**2


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def example(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features, the bias last."""
    hashes, n_words = feature_hashes(text, bits)
    places, counts = np.unique(hashes, return_counts=True)
    values = np.append(weigh(counts, n_words), 1.0)
    return np.append(places, 1 << bits).astype(np.int32), values.astype(np.float32)


def train(rows: Iterable[tuple[str, int]], options: ToxicityOptions) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights other than zero, learnt from (text, label) in the order given."""
    model = FtrlProximal(options)
    examples = [(*example(text, options.bits), label) for text, label in rows]
    for _ in range(options.epochs):
        for places, values, label in examples:
            model.learn(places, values, label)
    weights = model.weights()
    places = np.flatnonzero(weights)
    return places, weights[places]


class Scorer:
    """Scores texts with a dense copy of the weights."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, bits: int):
        self.bits = bits
        self.dense = np.zeros((1 << bits) + 1)
        self.dense[places] = weights
        self.known = self.dense != 0

    def __call__(self, text: str) -> float:
        hashes, n_words = feature_hashes(text, self.bits)
        known = hashes[self.known[hashes]]
        places, counts = np.unique(known, return_counts=True)
        return float(sigmoid(self.dense[-1] + self.dense[places] @ weigh(counts, n_words)))


def learn(docs: DataFrame, labels: DataFrame, usable: Column, options: ToxicityOptions) -> tuple[np.ndarray, np.ndarray]:
    """The model's weights, learnt in one task from the bounded sample in the order of an id hash.

    Without labelled rows all weights are zero. The sample's ids are written first; the file is small
    enough to be broadcast, so of the documents only the sample's are shuffled. Of rows that share an id one is
    learnt from, the first by a hash of its text, picked before the learning task.
    """
    chosen = sampled_labels(labels, "toxic", usable, options.sample)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(chosen, "doc_id")
    first = F.struct(F.xxhash64("text").alias("hash"), "text")
    rows = rows.groupBy("doc_id").agg(F.min(first).alias("first"), F.first("label").alias("label"))
    rows = rows.select("doc_id", "first.text", "label")
    order = F.xxhash64("doc_id", F.lit(23))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def examples():
            for batch in slices(batches):
                yield from zip(texts(batch), batch.column("label").to_pylist(), strict=True)

        places, weights = train(examples(), options)
        yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64()), "weight": pa.array(weights, pa.float64())})

    model = rows.repartition(1).sortWithinPartitions(order, "doc_id").mapInArrow(run, "place long, weight double").toPandas()
    return model["place"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)


def with_toxicity(docs: DataFrame, labels: DataFrame, name: str, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """The rows with the toxicity of their whole text, from 0 to 1, as column ``name``.

    Learns from labelled ids whose crc32 modulo 3 is not 1. Null and empty texts have no features and
    get the model's base score. Rows are scored one by one, repeated ones alike.
    """
    key = F.col("doc_id")
    places, weights = learn(docs, labels, held_out_remainder(key, 3) != 1, options)
    shared = docs.sparkSession.sparkContext.broadcast((places, weights))
    return with_score(docs, name, lambda: Scorer(*shared.value, options.bits))


def score_toxicity(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return judged(with_toxicity(rows, labels, "score", options), 3, 1, options.threshold)


def without_toxic(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """The documents below the threshold, with their own columns."""
    name = spare(docs, "toxicity")
    scored = with_toxicity(docs, labels, name, options)
    return scored.filter(F.col(name) < options.threshold).select(*docs.columns)
