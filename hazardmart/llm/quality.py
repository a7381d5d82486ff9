"""Quality scores by kernel ridge regression on document statistics.

Random Fourier features approximate a Gaussian kernel over a dozen statistics of the whole text.
Every partition sums its part of the normal equations, the driver adds the sums and solves them, and
isotonic regression on rows kept apart turns the fitted values into probabilities.
"""

from __future__ import annotations

import operator
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.common import held_out_remainder, judged, sampled_labels, slices, spare, texts, with_score
from hazardmart.sources.landed import land

SYMBOL_RUNS = re.compile(r"[^\w\s]{2,}")
LOWER, UPPER, DIGIT, SPACE, OTHER = range(5)


@dataclass(frozen=True)
class QualityOptions:
    """``sample``: labelled rows to learn from, about, chosen by a hash of their id.

    ``features``: random Fourier features; ``width``: of the kernel, in standard deviations of the
    statistics; ``ridge``: penalty; ``partitions``: of the sample; ``threshold``: least score of a
    document of quality.
    """

    sample: int = 15_000
    features: int = 256
    width: float = 4.0
    ridge: float = 1e-3
    partitions: int = 8
    threshold: float = 0.7
    seed: int = 3


@cache
def _classes() -> np.ndarray:
    """Class of every code point below U+3000; all above count as letters."""
    kinds = {"Lu": UPPER, "Lt": UPPER, "Nd": DIGIT, "Zs": SPACE, "Zl": SPACE, "Zp": SPACE, "Cc": SPACE}
    named = [unicodedata.category(chr(point)) for point in range(0x3000)]
    return np.array([kinds.get(kind, LOWER if kind[0] in "LM" else OTHER) for kind in named], np.uint8)


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; those of an empty text are zero."""
    if not text:
        return [0.0] * 14
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _classes()
    known = np.bincount(table[points[points < len(table)]], minlength=5)
    words, lines = text.split(), text.splitlines()
    n_chars, n_words = len(text), max(len(words), 1)
    counted = Counter(words)
    line_counts = Counter(lines)
    data = text.encode("utf-8", "surrogatepass")
    return [
        np.log1p(n_chars),
        np.log1p(len(words)),
        known[UPPER] / n_chars,
        known[DIGIT] / n_chars,
        known[SPACE] / n_chars,
        known[OTHER] / n_chars,
        len(SYMBOL_RUNS.findall(text)) / n_words,
        (n_chars - known[SPACE]) / n_words,
        len(counted) / n_words,
        max(counted.values(), default=0) / n_words,
        sum(map(operator.eq, words, words[1:])) / n_words,
        text.count("|") / n_words,
        1 - len(line_counts) / max(len(lines), 1),
        len(zlib.compress(data, 1)) / len(data),
    ]


class KernelRidge:
    """Random Fourier features of standardised statistics, fitted by the normal equations."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, options: QualityOptions):
        random = np.random.default_rng(options.seed)
        self.mean, self.deviation, self.options = mean, np.where(deviation > 1e-9, deviation, 1.0), options
        self.directions = random.normal(0, 1 / options.width, (len(mean), options.features))
        self.phases = random.uniform(0, 2 * np.pi, options.features)
        self.weights = np.zeros(options.features + 1)
        self.steps = (np.array([0.0]), np.array([0.5]))
        self.fitted = False

    def features(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.deviation, -6, 6)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / self.options.features)
        return np.hstack([waves, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(rows), *self.steps), 0, 1)

    def solve(self, products: np.ndarray, targets: np.ndarray, count: int) -> None:
        penalty = np.eye(len(products)) * self.options.ridge * max(count, 1)
        penalty[-1, -1] = 1e-9  # the constant is not penalised
        self.weights = np.linalg.solve(products + penalty, targets)


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the blocks of pooled adjacent violators, and their mean labels.

    Each block has one pseudo-observation of either label per thousand rows, which keeps scores off
    0 and 1 without moving the order.
    """
    order = np.argsort(values, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, first value, last value
    for value, label in zip(values[order], labels[order], strict=True):
        if blocks and blocks[-1][3] == value:
            blocks[-1][0] += label
            blocks[-1][1] += 1
        else:
            blocks.append([label, 1, value, value])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, rows, _, last = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += rows
            blocks[-1][3] = last
    ends = [(value, (total + 0.001) / (rows + 0.002)) for total, rows, first, last in blocks for value in (first, last)]
    return np.array([value for value, _ in ends]), np.maximum.accumulate([mean for _, mean in ends])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        matrix = np.stack(batch.column("x").to_numpy(zero_copy_only=False)) if batch.num_rows else np.empty((0, 14))
        yield matrix, batch.column("label").to_numpy(), batch.column("calibrates").to_numpy(zero_copy_only=False)


def learn(docs: DataFrame, labels: DataFrame, usable, options: QualityOptions) -> KernelRidge:
    """The model fitted to the bounded sample; without labelled rows every score is one half.

    What reaches the driver are the partitions' sums, of fixed size and number, and a fitted value and
    a label for a quarter of the sample. If all rows or none fall into that quarter, the model is both
    fitted and calibrated on all.
    """
    chosen = sampled_labels(labels, "quality", usable, options.sample)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(chosen, "doc_id")
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit(options.seed)), F.lit(4)) == 0
    rows = rows.select("doc_id", "text", "label", calibrates.alias("calibrates"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array(map(statistics, texts(batch)), pa.list_(pa.float64()))
            kept = [batch.column(name) for name in ("doc_id", "label", "calibrates")]
            yield pa.RecordBatch.from_arrays([found, *kept], names=["x", "doc_id", "label", "calibrates"])

    measured = rows.mapInArrow(measure, "x array<double>, doc_id long, label int, calibrates boolean")
    # Rows that share an id count once; of their texts only the statistics are shuffled.
    measured = measured.groupBy("doc_id").agg(*(F.min(name).alias(name) for name in ("x", "label", "calibrates"))).drop("doc_id")
    measured = land(measured.repartition(options.partitions), "statistics")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, 14))
        for matrix, _, calibrates in _rows(batches):
            total += [np.full(14, len(matrix)), matrix.sum(axis=0), (matrix**2).sum(axis=0), np.full(14, calibrates.sum())]
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    count, sums, squares, calibrating = sum(
        (np.frombuffer(row["sums"]).reshape(4, 14) for row in measured.mapInArrow(moments, "sums binary").collect()),
        np.zeros((4, 14)),
    )
    mean = sums / np.maximum(count, 1)
    model = KernelRidge(mean, np.sqrt(np.maximum(squares / np.maximum(count, 1) - mean**2, 0)), options)
    if not count[0]:
        return model

    size = options.features + 1
    apart = 0 < calibrating[0] < count[0]

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        rows = 0
        for matrix, label, calibrates in _rows(batches):
            fits = ~calibrates if apart else np.full(len(matrix), True)
            features = model.features(matrix[fits])
            total += features.T @ np.hstack([features, label[fits][:, None]])
            rows += len(features)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary()), "n": pa.array([rows], pa.int64())})

    parts = measured.mapInArrow(equations, "sums binary, n long").collect()
    total = sum(np.frombuffer(row["sums"]).reshape(size, size + 1) for row in parts)
    model.solve(total[:, :-1], total[:, -1], sum(row["n"] for row in parts))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix, label, calibrates in _rows(batches):
            known = calibrates if apart else np.full(len(matrix), True)
            values = model.raw(matrix[known])
            yield pa.RecordBatch.from_pydict({"value": pa.array(values), "label": pa.array(label[known].astype(np.float64))})

    kept = measured.mapInArrow(fitted, "value double, label double").toPandas()
    model.steps = isotonic(kept["value"].to_numpy(), kept["label"].to_numpy())
    model.fitted = True
    return model


def _learnt(docs: DataFrame, labels: DataFrame, options: QualityOptions) -> KernelRidge:
    return learn(docs, labels, held_out_remainder(F.col("doc_id"), 4) != 2, options)


def _scored(docs: DataFrame, model: KernelRidge, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scorer():
        model = shared.value
        return lambda text: float(model.scores(np.array([statistics(text)]))[0])

    return with_score(docs, name, scorer)


def with_quality(docs: DataFrame, labels: DataFrame, name: str, options: QualityOptions = QualityOptions()) -> DataFrame:
    """The rows with the quality of their whole text, from 0 to 1, as column ``name``.

    Learns from labelled ids whose crc32 modulo 4 is not 2. Null counts as the empty text, whose
    statistics are all zero. Rows are scored one by one, repeated ones alike.
    """
    return _scored(docs, _learnt(docs, labels, options), name)


def score_quality(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return judged(with_quality(rows, labels, "score", options), 4, 2, options.threshold)


def without_low_quality(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """The documents that reach the threshold, with their own columns; all if there is nothing to learn from."""
    model = _learnt(docs, labels, options)
    if not model.fitted:
        return docs
    name = spare(docs, "quality")
    return _scored(docs, model, name).filter(F.col(name) >= options.threshold).select(*docs.columns)
