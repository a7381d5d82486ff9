"""Spelling variants of words by a dictionary of trie node pairs.

Words are sorted once forward and once reversed; walking them in order numbers the nodes of the trie
of prefixes and of the trie of suffixes. A pair (prefix node, suffix node) then stands for a word
split at a position, or for a word with the character between them skipped. Words that differ by one
character share such a pair: a split pair with a skip pair if it was inserted, two skip pairs if it
was replaced. Only numbers are joined, and what shares a pair is at most one word and the words with
one character of the alphabet put in, so groups stay small.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.llm.common import slices, texts
from hazardmart.sources.landed import land

# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8.
RUNS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")


@dataclass(frozen=True)
class SpellingOptions:
    """``shortest``: code points of a word; ``least``: its occurrences; ``ratio``: how much more often
    than a word its form must occur; ``every``: one run of so many is misspelt, as its id and text
    decide; ``counted``: distinct words a task counts before it passes them on."""

    shortest: int = 7
    least: int = 2
    ratio: int = 10
    every: int = 31
    counted: int = 200_000


def vocabulary(docs: DataFrame, options: SpellingOptions = SpellingOptions()) -> DataFrame:
    """(word, n) of the words of whole texts, lower-cased in A-Z, that are long and frequent enough.

    A run whose crc32 with its document's id (none: empty) is divisible by ``every`` loses a character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                start = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for word, n in Counter(RUNS.findall(text.encode().lower())).items():
                    mark = zlib.crc32(word, start)
                    if mark % options.every == 0:
                        chars = word.decode()
                        place = mark % len(chars)
                        word = (chars[:place] + chars[place + 1 :]).encode()
                    if len(word) >= options.shortest:
                        counts[word] += n
            if len(counts) >= options.counted:
                yield _counted(counts, options.shortest)
                counts.clear()
        yield _counted(counts, options.shortest)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    totals = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return totals.filter(F.col("n") >= options.least)


def _counted(counts: Counter[bytes], shortest: int) -> pa.RecordBatch:
    kept = {word: n for word, n in ((word.decode(), n) for word, n in counts.items()) if len(word) >= shortest}
    return pa.RecordBatch.from_pydict({"word": pa.array(kept, pa.string()), "n": pa.array(kept.values(), pa.int64())})


def _shared(one: str, other: str) -> int:
    """Length of the longest common prefix."""
    place = 0
    for a, b in zip(one, other):
        if a != b:
            break
        place += 1
    return place


def _walked(keys: DataFrame) -> DataFrame:
    """(range, key, nodes): the trie nodes from the root to each key, numbered in sorted order range by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        first = number << 40
        before, nodes, following = "", [first], first + 1
        for batch in slices(batches):
            keys, found = batch.column(0).to_pylist(), []
            for key in keys:
                kept = _shared(before, key)
                nodes = nodes[: kept + 1] + [*range(following, following + len(key) - kept)]
                following += len(key) - kept
                found.append(nodes)
                before = key
            columns = pa.array([number] * len(keys), pa.int32()), batch.column(0), pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns], names=["range", "key", "nodes"])

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, "range int, key string, nodes array<long>")


def numbered(keys: DataFrame) -> DataFrame:
    """(key, nodes) of distinct strings: the numbers of the trie nodes on each key's path, the root first.

    Ranges are numbered on their own. A node that lies on the border of two has a number in each, so the
    first and last key of every range are compared, a few numbers per range, and later numbers give way
    to earlier ones. The last node of a key is its own, and these are numbered in the order of keys.
    """
    walked = land(keys.select(F.col(keys.columns[0]).alias("key")).transform(_walked), "nodes")
    ends = walked.groupBy("range").agg(
        F.min("key").alias("first"), F.max("key").alias("last"),
        F.min_by("nodes", "key").alias("first_nodes"), F.max_by("nodes", "key").alias("last_nodes"),
    )
    borders, last, path = [], "", []
    for row in ends.orderBy("range").collect():
        shared = _shared(last, row["first"]) + 1 if path else 0
        old, new = row["first_nodes"][:shared], path[:shared]
        borders.append((row["range"], old, new))
        renamed = dict(zip(old, new))
        last, path = row["last"], [renamed.get(node, node) for node in row["last_nodes"]]
    kinds = {"own": pa.int32(), "old": pa.list_(pa.int64()), "new": pa.list_(pa.int64())}
    table = pa.table({name: pa.array([row[i] for row in borders], kind) for i, (name, kind) in enumerate(kinds.items())})
    joined = walked.join(keys.sparkSession.createDataFrame(table), F.col("range") == F.col("own"))

    def renamed(node: Column, at: Column) -> Column:
        return F.when(F.get("old", at) == node, F.get("new", at)).otherwise(node)

    return joined.select("key", F.transform("nodes", renamed).alias("nodes"))


def _pairs(words: DataFrame) -> DataFrame:
    """(pre, suf, entry) of each split and skip position; an entry is (-n, wid, kind).

    Kinds: 0 split, 1 skip, 2 skip of the last of a run of equal characters, which stands for all of
    them: without it the word is the same, whichever of the run is missing.
    """
    size = F.size("chars")

    def pair(prefix: Column, suffix: Column, kind: Column) -> Column:
        entry = F.struct((-F.col("n")).alias("rare"), "wid", kind.cast("byte").alias("kind"))
        return F.struct(F.get("prefixes", prefix).alias("pre"), F.get("suffixes", suffix).alias("suf"), entry.alias("entry"))

    def skip(at: Column) -> Column:
        last = F.get("chars", at) != F.coalesce(F.get("chars", at + 1), F.lit(""))
        return pair(at, size - at - 1, F.when(last, 2).otherwise(1))

    splits = F.transform(F.sequence(F.lit(0), size), lambda at: pair(at, size - at, F.lit(0)))
    skips = F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), skip))
    return words.select(F.inline(F.concat(splits, F.coalesce(skips, F.array()))))


def _near(pairs: DataFrame) -> DataFrame:
    """(wid, n_near, best): how many words are near and the most frequent one, as (-n, wid).

    A group holds at most one word that is split there and a word per character of the alphabet. Each
    member gets a count and a best from the group, never a row per pair.
    """
    groups = pairs.repartition("pre", "suf").groupBy("pre", "suf").agg(F.collect_list("entry").alias("own"))
    groups = groups.filter(F.size("own") > 1)
    groups = groups.select(
        "own",
        F.slice(F.array_sort(F.filter("own", lambda entry: entry["kind"] > 0)), 1, 2).alias("top"),
        F.size(F.filter("own", lambda entry: entry["kind"] > 0)).alias("n_skips"),
        F.array_min(F.filter("own", lambda entry: entry["kind"] == 2)).alias("final"),
        F.size(F.filter("own", lambda entry: entry["kind"] == 2)).alias("n_final"),
        F.get(F.filter("own", lambda entry: entry["kind"] == 0), F.lit(0)).alias("split"),
    )

    def best(entry: Column) -> Column:
        return F.when(entry.isNotNull(), F.struct(entry["rare"].alias("rare"), entry["wid"].alias("wid")))

    def share(entry: Column) -> Column:
        whole = F.col("split").isNotNull() & (entry["kind"] == 2)
        other = best(F.when(F.get("top", F.lit(0))["wid"] != entry["wid"], F.get("top", F.lit(0))).otherwise(F.get("top", F.lit(1))))
        skipped = F.array_min(F.array(other, F.when(whole, best(F.col("split")))))
        n_near = F.when(entry["kind"] == 0, F.col("n_final")).otherwise(F.col("n_skips") - 1 + whole.cast("int"))
        found = F.when(entry["kind"] == 0, best(F.col("final"))).otherwise(skipped)
        return F.struct(entry["wid"].alias("wid"), n_near.cast("long").alias("n_near"), found.alias("best"))

    shares = groups.select(F.inline(F.transform("own", share))).filter("n_near > 0")
    return shares.groupBy("wid").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(wid, root) of links (wid, to): where following them ends.

    Each step doubles how far a link reaches. Occurrences grow along links, at least ``ratio``-fold, so
    a chain has fewer links than a count has digits.
    """
    roots = land(links.select("wid", F.col("to").alias("root")), "roots")
    while True:
        further = roots.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        if not roots.join(further, "root", "left_semi").take(1):
            return roots
        roots = land(roots.join(further, "root", "left").select("wid", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) with distinct words, none of them null.

    Near words differ by one code point put in, left out or replaced. A word's form is the near word
    of largest n (ties: the smallest), if that is at least ``ratio`` (more than 1) times its own.
    """
    words = land(words.select("word", "n"), "words")
    prefixes = numbered(words.select("word")).select(F.col("key").alias("word"), F.col("nodes").alias("prefixes"))
    suffixes = numbered(words.select(F.reverse("word"))).select(F.reverse("key").alias("word"), F.col("nodes").alias("suffixes"))
    known = words.join(prefixes, "word").join(suffixes, "word")
    chars = F.when(F.length("word") == 0, F.array().cast("array<string>")).otherwise(F.split("word", ""))
    known = land(known.select("*", F.element_at("prefixes", -1).alias("wid"), chars.alias("chars")), "paths")
    near = land(_near(_pairs(known)), "near")
    named = known.select("wid", "word", "n")
    judged = named.join(near, "wid", "left").withColumn("form_n", -F.col("best.rare"))
    judged = judged.withColumn("to", F.when(F.col("form_n") >= ratio * F.col("n"), F.col("best.wid")))
    judged = land(judged.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "to", F.when(F.col("to").isNotNull(), F.col("form_n")).alias("form_n")), "judged")
    roots = _roots(judged.filter("to IS NOT NULL").select("wid", "to"))
    forms = named.select(F.col("wid").alias("to"), F.col("word").alias("form"))
    tops = roots.join(named.select(F.col("wid").alias("root"), F.col("word").alias("top")), "root").select("wid", "top")
    whole = judged.join(forms, "to", "left").join(tops, "wid", "left")
    return whole.select("word", "form", F.coalesce("top", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, options: SpellingOptions = SpellingOptions()) -> DataFrame:
    """The words of whole texts (null: none) with their near words and forms.

    Every row counts, repeated ones and rows without doc_id too; other columns are not read. Words may
    be of any length. Without words the result is empty.
    """
    return variants(vocabulary(docs, options), options.ratio)


def oracle() -> str:
    """``spelling_variants`` with the default options as SQL: near words by all their gaps and deletions."""
    table = "list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), n))"
    codes = "list_transform(range(0, strlen(keyed)), lambda i: ('0x' || substr(hex(keyed), 2 * i + 1, 2))::BIGINT)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT {table} AS steps
), runs AS (
  SELECT doc_id, translate(run, '{upper}', '{lower}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL
), keyed AS (
  SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS keyed FROM runs
), marked AS (
  SELECT run, n, xor(list_reduce({codes}, lambda c, byte: xor(c >> 8, steps[(xor(c, byte) & 255) + 1]), 4294967295), 4294967295) AS mark
  FROM keyed, crc
), changed AS (
  SELECT CASE WHEN mark % 31 = 0 THEN substr(run, 1, mark % length(run)) || substr(run, mark % length(run) + 2) ELSE run END AS word, n
  FROM marked
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), gaps AS (
  SELECT word, n, substr(word, 1, place) AS head, substr(word, place + 2) AS tail
  FROM (SELECT *, unnest(range(0, length(word))) AS place FROM words)
), replaced AS (
  SELECT a.word, b.word AS other FROM gaps a JOIN gaps b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
), missing AS (
  SELECT DISTINCT g.word, w.word AS other FROM gaps g JOIN words w ON g.head || g.tail = w.word
), near AS MATERIALIZED (
  SELECT * FROM replaced UNION SELECT * FROM missing UNION SELECT other, word FROM missing
), ranked AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS place
  FROM near JOIN words o ON o.word = other
), judged AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
), followed AS (
  SELECT word, word AS root FROM judged WHERE form IS NULL
  UNION ALL
  SELECT j.word, f.root FROM judged j JOIN followed f ON j.form = f.word
)
SELECT j.word, j.form, f.root, j.n, j.n_near, j.form_n FROM judged j JOIN followed f ON j.word = f.word
"""
