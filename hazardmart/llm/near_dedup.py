"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

Documents with the same set of word shingles form a class; one representative stands for it. Bands
of MinHash values bring representatives together as candidates. All samples are also folded into a
parity bitmap (odd sketch): the population count of two bitmaps' XOR estimates how many samples
differ, and candidates far below the threshold go. The rest are confirmed on their full sets.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.common import BoundedCache, hash_sequence, slices, spare, texts, word_hashes
from hazardmart.llm.components import components
from hazardmart.sources.landed import land

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class DedupOptions:
    """``percent``: least Jaccard similarity of a link; ``words``: words of a shingle.

    ``bands`` of ``band_size`` MinHash values each: a pair at exactly 0.75 shares no band with a
    probability of 2e-6. ``sketch_bits`` and ``set_bits``: sizes of the odd
    sketches of the samples and of the set; candidates are dropped unconfirmed
    only when it differs in more than ``most_differing`` bits, six standard deviations beyond what
    pairs at the threshold have, or when the sets' sketches do so by as much. ``rounds``: of linking components before all candidates left are
    compared. ``block``: members of a bucket that one task compares at a time. ``filter_bits``: of
    the bitmap that says which documents' sets are needed; a full one only costs time.
    """

    percent: int = 75
    words: int = 5
    bands: int = 48
    band_size: int = 5
    sketch_bits: int = 1024
    set_bits: int = 2048
    most_differing: int = 180
    rounds: int = 3
    block: int = 2048
    filter_bits: int = 1 << 24
    seed: int = 5


@cache
def _words() -> BoundedCache:
    return word_hashes()


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = WORDS.findall(text.encode().lower())  # of bytes, only A-Z become lower case
    if not words:
        return np.empty(0, np.uint64)
    known = _words()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return np.unique(hash_sequence(hashes, min(size, len(words))))


class Signer:
    """MinHash samples of shingle sets, cut into bands and folded into odd sketches."""

    def __init__(self, options: DedupOptions):
        random = np.random.default_rng(options.seed)
        count = options.bands * options.band_size
        self.options = options
        self.factors = (random.integers(0, 2**32, count, np.uint64) | 1).astype(np.uint32)[:, None]
        self.offsets = random.integers(0, 2**32, count, np.uint64).astype(np.uint32)[:, None]
        self.places = random.integers(0, 2**64, count, np.uint64)
        self.band_seeds = random.integers(0, 2**64, options.bands, np.uint64)

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.factors), 2**32 - 1, np.uint32)
        for start in range(0, len(short), 512):
            drawn = (short[start : start + 512] * self.factors + self.offsets).min(axis=1)
            np.minimum(least, drawn, out=least)
        return least

    def sign(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and odd sketches, both as signed 64-bit integers.

        The first sketch is of the samples, whatever the set's size. The second is of the shingles
        themselves and counts the differing ones almost exactly while they are few.
        """
        samples = self.samples(hashes).astype(np.uint64)
        keys = self.band_seeds.copy()
        for column in samples.reshape(self.options.bands, self.options.band_size).T:
            keys = (keys ^ column) * np.uint64(0xFF51AFD7ED558CCD)
            keys ^= keys >> np.uint64(29)
        mixed = (samples ^ self.places) * np.uint64(0xC4CEB9FE1A85EC53)
        mixed ^= mixed >> np.uint64(32)
        parities = [self._parities(mixed, self.options.sketch_bits), self._parities(hashes, self.options.set_bits)]
        return keys.view(np.int64), np.packbits(np.concatenate(parities)).view(np.int64)

    @staticmethod
    def _parities(hashes: np.ndarray, bits: int) -> np.ndarray:
        return (np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)


def signatures(docs: DataFrame, options: DedupOptions) -> DataFrame:
    """Per row: doc_id, set size, 128-bit fingerprint of the set, band keys and odd sketch (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(options)
        for batch in slices(batches):
            rows = [shingles(text, options.words) for text in texts(batch)]
            prints = [xxhash.xxh3_128_digest(row.tobytes()) if len(row) else None for row in rows]
            signed = [signer.sign(row) if len(row) else (None, None) for row in rows]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(row) for row in rows], pa.int64()),
                    "print": pa.array(prints, pa.binary()),
                    "bands": pa.array([keys for keys, _ in signed], longs),
                    "sketch": pa.array([sketch for _, sketch in signed], longs),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, print binary, bands array<long>, sketch array<long>")


def _may_be_near(one: list[Column], other: list[Column], n_one: Column, n_other: Column, options: DedupOptions) -> Column:
    """Whether two sketches (as columns of 64 bits) leave it possible that the sets reach the threshold.

    Sets at the threshold differ in (100 - p) / (100 + p) of their summed sizes. That many elements
    leave odd counts in a bitmap of m bits with the mean and variance below; a margin of six
    standard deviations and two bits is added.
    """
    counts = [F.bit_count(a.bitwiseXOR(b)) for a, b in zip(one, other, strict=True)]
    longs, m = options.sketch_bits // 64, float(options.set_bits)
    samples, elements = reduce(operator.add, counts[:longs]), reduce(operator.add, counts[longs:])
    load = (n_one + n_other) * ((100 - options.percent) / (100 + options.percent) / m)
    mean = m / 2 * (1 - F.exp(-2 * load))
    variance = m / 4 * (1 - F.exp(-4 * load) * (1 + 4 * load))
    return (samples <= options.most_differing) & (elements <= mean + 6 * F.sqrt(variance) + 2)


def _longs(sketch: Column, options: DedupOptions) -> list[Column]:
    return [sketch[i] for i in range((options.sketch_bits + options.set_bits) // 64)]


def _sketched(pairs: DataFrame, classes: DataFrame, options: DedupOptions) -> DataFrame:
    """The pairs (a, b) whose odd sketches do not rule the threshold out."""
    for side in ("a", "b"):
        own = classes.select(F.col("doc").alias(side), F.col("sketch").alias(f"sketch_{side}"), F.col("n_shingles").alias(f"n_{side}"))
        pairs = pairs.join(own, side)
    one, other = (_longs(F.col(f"sketch_{side}"), options) for side in ("a", "b"))
    return pairs.filter(_may_be_near(one, other, F.col("n_a"), F.col("n_b"), options)).select("a", "b")


def _id_places(ids: pa.Array, bits: int) -> np.ndarray:
    mixed = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ mixed >> np.uint64(32)) % np.uint64(bits)


def _bit(places: np.ndarray) -> np.ndarray:
    """The bit of each place inside its byte."""
    return np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)


def _id_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size with the bit of every id set, put together from a few tasks' bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            places = _id_places(batch.column(0), bits)
            np.bitwise_or.at(marked, places >> np.uint64(3), _bit(places))
        yield pa.RecordBatch.from_pydict({"bits": pa.array([marked.tobytes()], pa.binary())})

    parts = ids.repartition(4).mapInArrow(run, "bits binary").toLocalIterator()
    return reduce(np.bitwise_or, (np.frombuffer(row["bits"], np.uint8) for row in parts), np.zeros(bits // 8, np.uint8))


def _confirmed(pairs: DataFrame, docs: DataFrame, options: DedupOptions) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    The sets are made again from the texts, of those documents alone that a bitmap of the pairs' ids
    lets through, so that no text is shuffled. The pairs are written first: they are read twice.
    """
    pairs = land(pairs, "candidates")
    marked = _id_filter(pairs.select(F.explode(F.array("a", "b"))), options.filter_bits)
    shared = docs.sparkSession.sparkContext.broadcast(marked)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = shared.value
        for batch in batches:
            places = _id_places(batch.column("doc_id"), options.filter_bits)
            needed = (marked[places >> np.uint64(3)] & _bit(places) != 0) & batch.column("doc_id").is_valid().to_numpy(False)
            for part in slices([batch.filter(pa.array(needed))]):
                found = [shingles(text, options.words).tobytes() for text in texts(part)]
                yield pa.RecordBatch.from_pydict({"doc": part.column("doc_id"), "shingles": pa.array(found, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    full = land(rows.mapInArrow(sets, "doc long, shingles binary"), "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            reach = []
            for one, other in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                one, other = (np.frombuffer(side.as_buffer(), np.uint64) for side in (one, other))
                shared = len(np.intersect1d(one, other, assume_unique=True))
                reach.append(100 * shared >= options.percent * (len(one) + len(other) - shared))
            kept = batch.filter(pa.array(reach, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    both = pairs
    for side in ("a", "b"):
        both = both.join(full.select(F.col("doc").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    return land(both.mapInArrow(compare, "a long, b long"), "near")


def _labelled(crowded: DataFrame, found: DataFrame | None) -> DataFrame:
    """The bucket rows (key, doc) with the component that the links found so far give."""
    rows = crowded.select("key", "doc")
    if found is None:
        return rows.withColumn("component", F.col("doc"))
    named = found.select(F.col("node").alias("doc"), "component")
    return rows.join(named, "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))


def _joining_pairs(labelled: DataFrame, tried: DataFrame | None) -> DataFrame:
    """For every component one pair that may join it to a smaller one, not tried before.

    In each bucket the members of other components meet the first member of the smallest one. Of
    all pairs of a component the one that shares most buckets is taken.
    """
    pivots = labelled.groupBy("key").agg(F.min(F.struct("component", "doc")).alias("pivot"), F.max("component").alias("last"))
    pivots = pivots.filter("pivot.component < last").select("key", "pivot")
    met = labelled.join(pivots, "key").filter(F.col("component") > F.col("pivot.component"))
    counted = met.groupBy("component", F.col("doc").alias("a"), F.col("pivot.doc").alias("b")).agg(F.count("*").alias("n"))
    if tried is not None:
        counted = counted.join(tried, ["a", "b"], "left_anti")
    best = counted.groupBy("component").agg(F.max(F.struct(F.col("n"), (-F.col("b")).alias("b"), F.col("a"))).alias("best"))
    return best.select(F.col("best.a").alias("a"), (-F.col("best.b")).alias("b"))


def _across(labelled: DataFrame, classes: DataFrame, options: DedupOptions) -> DataFrame:
    """Candidate pairs of a bucket that no links connect so far, by their odd sketches.

    Buckets whose members are all connected give none. Large buckets are cut into blocks, and each
    pair of blocks is compared on its own. Only pairs that pass the sketch leave the join.
    """
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("n")
    )
    blocks = F.ceil(F.col("n") / options.block).cast("long")
    mixed = mixed.filter("first < last").select("key", blocks.alias("blocks"))
    known = classes.select("doc", "sketch", "bands", "n_shingles")
    members = labelled.join(mixed, "key").join(known, "doc")
    members = land(members.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks"))), "mixed")
    longs = (options.sketch_bits + options.set_bits) // 64

    def side(name: str, own: str, other: str, numbers: Column) -> DataFrame:
        parts = [part.alias(f"{name}{i}") for i, part in enumerate(_longs(F.col("sketch"), options))]
        return members.select(
            "key", F.col("block").alias(own), F.explode(numbers).alias(other), F.col("doc").alias(name), *parts,
            *(F.col(column).alias(f"{name}_{column}") for column in ("component", "bands", "n_shingles")),
        )

    low = side("a", "low", "high", F.sequence(F.col("block"), F.col("blocks") - 1))
    high = side("b", "high", "low", F.sequence(F.lit(0).cast("long"), F.col("block")))
    one, other = ([F.col(f"{name}{i}") for i in range(longs)] for name in ("a", "b"))
    near = _may_be_near(one, other, F.col("a_n_shingles"), F.col("b_n_shingles"), options)
    ordered = (F.col("low") < F.col("high")) | (F.col("a") < F.col("b"))
    across = F.col("a_component") != F.col("b_component")
    # A pair leaves only the bucket of its first common band.
    common = F.filter(F.zip_with("a_bands", "b_bands", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
    first = F.element_at(common, 1) == F.col("key")
    pairs = low.join(high, ["key", "low", "high"]).filter(ordered & across & near & first)
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _linked(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the links found so far and of further ones."""
    if found is not None:
        links = found.select("node", "component").union(links)
    return land(components(links), "components")


def _shared_ids(whole: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the representatives of the classes that share a doc_id."""
    mark = F.xxhash64("print")
    several = whole.groupBy("doc_id").agg(F.min(mark).alias("least"), F.max(mark).alias("most")).filter("least < most")
    several = land(several.select("doc_id"), "shared_ids")
    own = whole.join(several, "doc_id").select("doc_id", "print").distinct().join(classes.select("print", "doc"), "print")
    least = own.groupBy("doc_id").agg(F.min("doc").alias("b"))
    return land(own.join(least, "doc_id").filter("b < doc").select(F.col("doc").alias("a"), "b").distinct(), "pairs")


def near_duplicates(docs: DataFrame, options: DedupOptions = DedupOptions()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept (whether it is the component's smallest id).

    Texts are lower-cased in A-Z and split at ASCII white space. Null and empty texts have no
    shingles and are linked with nothing; a text of fewer words than a shingle is one shingle. Rows
    that share a doc_id count as one node and keep their own set sizes. A row without doc_id takes
    the component of an equal set, else none, and is kept only in the latter case. Other columns
    are not read. An empty table gives an empty result.
    """
    signed = land(signatures(docs, options), "signatures")
    whole = signed.filter("doc_id IS NOT NULL AND print IS NOT NULL")
    classes = whole.groupBy("print").agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles"))
    classes = land(classes, "classes")
    buckets = classes.select("doc", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("doc").alias("leader"), F.max("doc").alias("last"))
    crowded = land(buckets.join(leaders.filter("leader < last").select("key", "leader"), "key"), "crowded")

    found = tried = None
    for _ in range(options.rounds):
        pairs = land(_joining_pairs(_labelled(crowded, found), tried), "pairs")
        if not pairs.take(1):
            break
        tried = pairs if tried is None else tried.union(pairs)
        found = _linked(found, _confirmed(_sketched(pairs, classes, options), docs, options))
    rest = land(_across(_labelled(crowded, found), classes, options), "pairs")
    if tried is not None:
        rest = rest.join(tried, ["a", "b"], "left_anti")
    if rest.take(1):
        found = _linked(found, _confirmed(rest, docs, options))
    if found is None:
        found = _linked(None, rest)
    shared = _shared_ids(whole, classes)
    if shared.take(1):
        found = _linked(found, shared)

    named = classes.select("print", "doc").join(found.withColumnRenamed("node", "doc"), "doc", "left")
    named = named.select("print", F.coalesce("component", "doc").alias("component"))
    labelled = signed.select("doc_id", "n_shingles", "print").join(named, "print", "left")
    component = F.coalesce("component", "doc_id")
    return labelled.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_duplicates(docs: DataFrame, options: DedupOptions = DedupOptions()) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Texts decide, not ids: rows that share a doc_id stay or go each by its own text, and rows without
    one are compared like others and come after those with an id. Of rows with equal id and text, one stays.
    """
    names, key = docs.columns, F.col("doc_id").cast("long")
    known, node, shares = (spare(docs, name) for name in ("known_id", "node", "shares_id"))
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    texts_of = docs.groupBy(key.alias(known)).agg(F.min(mark).alias("least"), F.max(mark).alias("most"))
    several = land(texts_of.filter(F.col(known).isNull() | (F.col("least") < F.col("most"))).select(known), "shared_ids")
    marked = several.filter(F.col(known).isNotNull()).withColumn(shares, F.lit(True))
    # A node for each id and text: the id, or a hash of both where the id is missing or has several texts.
    derived = F.col(shares).isNotNull() | F.col(known).isNull()
    rows = docs.withColumn(known, key).join(marked, known, "left")
    rows = rows.withColumn(node, F.when(derived, F.xxhash64(F.lit("node"), known, mark)).otherwise(F.col(known)))
    nodes = rows.select(F.col(node).alias("doc_id"), "text")
    judged = land(near_duplicates(nodes, options).select(F.col("doc_id").alias(node), "component_id", "kept"), "near_duplicates")
    # Only rows whose node occurs again are shuffled with their texts.
    again = land(judged.groupBy(node).agg(F.count("*").alias("n")).filter("n > 1").select(node), "again")
    kept = judged.filter("kept").select(node).distinct()
    if several.take(1):
        # Derived nodes have no order of their own: the smallest real id of a component counts.
        order = F.struct(F.col(known).isNull().alias("last"), F.col(known).alias("id"), F.col(node).alias("node"))
        named = rows.select(node, known).distinct().join(judged.drop("kept").distinct(), node)
        kept = named.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.node").alias(node))
    left = rows.join(land(kept, "kept"), node, "left_semi")
    if not again.take(1):
        return left.select(*names)
    once = left.join(again, node, "left_anti").select(*names)
    return once.union(left.join(again, node, "left_semi").dropDuplicates([node]).select(*names))
