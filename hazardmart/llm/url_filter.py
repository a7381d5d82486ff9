"""Exact URL rules by cascades of Bloom filters.

A cascade holds a key list. Level 0 encodes the listed keys; level 1 those keys of the corpus's
complete key universe that level 0 takes in falsely; level 2 the listed keys that level 1 takes in
falsely; and so on until nothing is falsely taken in. For every key of the universe the level that
first refuses it then tells exactly whether it is listed, without a join.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.common import slices


def key_hash(key: str) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"))
    return digest >> 64, (digest & (2**64 - 1)) | 1


class Bloom:
    """Bloom filter with the bits for ``keys`` at the given false positive rate."""

    def __init__(self, keys: Iterable[str], rate: float, level: int):
        keys = list(keys)
        self.level = level
        self.hashes = max(1, round(-math.log2(rate)))
        self.size = max(8, math.ceil(len(keys) * self.hashes / math.log(2)))
        self.bits = bytearray(-(-self.size // 8))
        for key in keys:
            for place in self._places(key):
                self.bits[place >> 3] |= 1 << (place & 7)

    def _places(self, key: str) -> Iterator[int]:
        start, step = key_hash(f"{self.level}:{key}")
        return ((start + i * step) % self.size for i in range(self.hashes))

    def __contains__(self, key: str) -> bool:
        return all(self.bits[place >> 3] >> (place & 7) & 1 for place in self._places(key))


class Cascade:
    """Levels that tell listed keys from all other keys of the universe."""

    def __init__(self, first: Bloom, listed: frozenset[str], taken_in: Iterable[str]):
        """``taken_in``: the universe's keys that are not listed but that ``first`` contains."""
        self.levels = [first]
        refused, kept = set(taken_in), set(listed)
        while refused:
            level = Bloom(refused, 0.5, len(self.levels))
            self.levels.append(level)
            # What the new level takes in falsely is what the next one has to encode.
            refused, kept = {key for key in kept if key in level}, refused

    def __contains__(self, key: str) -> bool:
        for number, level in enumerate(self.levels):
            if key not in level:
                return number % 2 == 1
        return len(self.levels) % 2 == 1


@dataclass(frozen=True)
class Rules:
    """Host and path prefixes, written together (``example.com/en/``), to allow and to block."""

    allow: frozenset[str]
    block: frozenset[str]

    def __post_init__(self):
        if self.allow & self.block:
            raise ValueError(f"rules both allowed and blocked: {sorted(self.allow & self.block)}")

    def shapes(self) -> list[tuple[int, int]]:
        """Host labels and path characters that rules have."""
        parted = [rule.partition("/") for rule in self.allow | self.block]
        return sorted({(host.count(".") + 1, len(slash + path)) for host, slash, path in parted})


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Host suffixes with path prefixes of the shapes that rules have, longest first.

    Equally long keys come with the longer host first. Only as many keys as there are shapes arise,
    however long the url is.
    """
    labels = F.split(host, r"\.")
    keys = []
    for n_labels, n_path in shapes:
        suffix = F.array_join(F.slice(labels, F.size(labels) - n_labels + 1, F.lit(n_labels)), ".")
        key = F.concat(suffix, F.substring(path, 1, n_path) if n_path else F.lit(""))
        fits = (F.size(labels) >= n_labels) & (F.length(path) >= n_path)
        keys.append(F.when(fits, F.struct(F.length(key).alias("n"), F.length(suffix).alias("h"), key.alias("key"))))
    if not keys:
        return F.array().cast("array<string>")
    ordered = F.sort_array(F.array_compact(F.array(*keys)), asc=False)
    return ordered.getField("key")


def _build(keys: DataFrame, listed: frozenset[str], universe: int, salt: int) -> Cascade | None:
    """A cascade for ``listed`` over the universe ``keys`` (one column, repeated keys allowed).

    The rate of level 0 lets about as many keys through as are listed, so what reaches the driver is
    of the list's size however large the corpus is.
    """
    if not listed:
        return None
    rate = min(0.5, max(len(listed) / max(universe, 1), 1e-12))
    first = Bloom(listed, rate, salt)

    def falsely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {key for key in batch.column("key").to_pylist() if key not in listed and key in first}
            yield pa.RecordBatch.from_pydict({"key": pa.array(sorted(found), pa.string())})

    taken_in = keys.mapInArrow(falsely, "key string").distinct()
    most = 1000 + 20 * len(listed)
    found = [row["key"] for row in taken_in.limit(most + 1).collect()]
    if len(found) > most:  # an unlucky seed; try the next one
        return _build(keys, listed, universe, salt + 1000)
    return Cascade(first, listed, found)


def judge_urls(
    pages: DataFrame, rules: Rules, url: str = "url", key: str = "page_id", otherwise: str = "allow"
) -> DataFrame:
    """Per row: key, host, path, the longest rule that fits (else null) and its verdict.

    A rule fits its host and all subdomains if the path starts with the rule's path. A url that is
    null or has no ``://`` has empty host and path and gets ``otherwise``, the verdict of keys that
    no cascade lists. Repeated rows give repeated results; no other column is read.
    """
    parted = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    parted = parted.select("key", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    offered = parted.select("*", candidate_keys(F.col("host"), F.col("path"), rules.shapes()).alias("keys"))
    universe = offered.select(F.explode("keys").alias("key"))
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    cascades = {"allow": _build(universe, rules.allow, size, 0), "block": _build(universe, rules.block, size, 0)}
    named = [(verdict, cascade) for verdict, cascade in cascades.items() if cascade]

    def judge(keys: list[str] | None) -> tuple[str | None, str]:
        for candidate in keys or ():
            for verdict, cascade in named:
                if candidate in cascade:
                    return candidate, verdict
        return None, otherwise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            judged = [judge(keys) for keys in batch.column("keys").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name) for name in ("key", "host", "path")}
                | {
                    "rule": pa.array([rule for rule, _ in judged], pa.string()),
                    "verdict": pa.array([verdict for _, verdict in judged], pa.string()),
                }
            )

    kind = parted.schema["key"].dataType.simpleString()
    schema = f"key {kind}, host string, path string, rule string, verdict string"
    return offered.mapInArrow(run, schema).withColumnRenamed("key", key)


def oracle(rules: Rules, otherwise: str = "allow") -> str:
    """``judge_urls`` as SQL."""
    listed = [*((rule, "allow") for rule in sorted(rules.allow)), *((rule, "block") for rule in sorted(rules.block))]
    values = ", ".join(
        "('{}', '{}', '{}{}', '{}')".format(rule, (parts := rule.partition("/"))[0], parts[1], parts[2], verdict)
        for rule, verdict in listed
    )
    return f"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {values}),
parted AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
)
SELECT page_id, host, path,
  (SELECT rule FROM rules WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
   ORDER BY length(rule) DESC, length(rule_host) DESC LIMIT 1) AS rule,
  coalesce((SELECT verdict FROM rules WHERE (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
   ORDER BY length(rule) DESC, length(rule_host) DESC LIMIT 1), '{otherwise}') AS verdict
FROM parted
"""
