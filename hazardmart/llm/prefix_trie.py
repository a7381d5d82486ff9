"""Prefix trie of conversations by van Emde Boas recursion over depths.

Sequences of turns are cut at half their depth, halves are cut again, and so on. On the way up
aligned runs of turns are fingerprinted from their halves; on the way down the prefix that ends at each
cut gets its name from the name of the cut before and the run between, all cuts of one width in one
step. An upper trie and the lower forests below its cuts thus arise side by side. Totals go back
the same way: each forest sums itself, and its sum is grafted on the cut prefix and the nodes above it
in the upper trie. A trie of depth d takes about log2(d) steps, however many conversations there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardmart.sources.landed import land

# Members of a node whose ids are joined to one text before they are hashed.
IDS_AT_ONCE = 4096


def turns_of(conversations: DataFrame) -> DataFrame:
    """Per turn: conv, place (from 1, by turn), mark (a digest of role and text) and bytes of its text.

    Null turns come first; turns alike in number are ordered by their marks, so repeated rows are turns
    of their own and the order does not depend on where rows are stored. Turns are sorted by ranges of
    conversation and turn, so that one conversation may hold any share of all rows.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    size = F.octet_length(text)
    marked = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("mark"),
        size.cast("long").alias("bytes"),
        # Spreads rows that are alike in everything.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv", "turn", "mark", "row"]
    ranged = land(marked.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "turns")
    # At most as many rows as ranges, plus one per conversation.
    sizes = ranged.groupBy("conv", "range").agg(F.count("*").alias("n"))
    lower = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    below = sizes.select("conv", "range", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below"))
    inside = F.row_number().over(Window.partitionBy("conv", "range").orderBy("turn", "mark", "row"))
    placed = ranged.withColumn("inside", inside).join(below, ["conv", "range"])
    return placed.select("conv", (F.col("inside") + F.col("below")).alias("place"), "mark", "bytes")


def rebuilt(turns: DataFrame, family: int = 5, shared: int = 9) -> DataFrame:
    """Per turn of the rebuilt conversations: conv, depth (from 1), mark, bytes.

    Conversation c begins with the first crc32(c) % ``shared`` turns of conversation c - c % ``family``
    (all, if it has fewer; none, if there is none); its own turns after as many follow.
    """
    turns = land(turns, "placed")
    convs = turns.groupBy("conv").agg(F.max("place").alias("n"))
    head = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(shared))
    convs = convs.withColumn("head", head).withColumn("base", F.col("conv") - F.col("conv") % family)
    # A base has fewer than ``shared`` turns to give, and fewer than 2 * ``family`` conversations to give them to.
    first = turns.filter(F.col("place") < shared).select(F.col("conv").alias("base"), "place", "mark", "bytes")
    heads = convs.select("conv", "head", "base").join(first, "base").filter("place <= head")
    lengths = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    moved = convs.join(lengths, "base", "left").select("conv", "head", F.least("head", F.coalesce("base_n", F.lit(0))).alias("given"))
    tails = turns.join(moved, "conv").filter("place > head")
    tails = tails.select("conv", (F.col("place") - F.col("head") + F.col("given")).alias("depth"), "mark", "bytes")
    return heads.select("conv", F.col("place").alias("depth"), "mark", "bytes").union(tails)


def _digest(*parts: Column) -> Column:
    """A 128-bit name; different parts get equal names with a probability of about 1e-38."""
    return F.unhex(F.md5(F.concat(*parts)))


def _runs(steps: DataFrame, widest: int) -> dict[int, DataFrame]:
    """By width (1, 2, 4, ...), the runs that fill an aligned place, as (conv, end, mark): up to ``widest``."""
    runs = {1: steps.select("conv", F.col("depth").alias("end"), "mark")}
    for width in (1 << level for level in range(1, widest.bit_length())):
        left = (F.col("end") / (width // 2)) % 2 == 1
        halves = runs[width // 2].groupBy("conv", (F.ceil(F.col("end") / width) * width).cast("long").alias("whole"))
        both = halves.agg(F.max(F.when(left, F.col("mark"))).alias("one"), F.max(F.when(~left, F.col("mark"))).alias("other"))
        both = both.filter("one IS NOT NULL AND other IS NOT NULL")
        runs[width] = land(both.select("conv", F.col("whole").alias("end"), _digest("one", "other").alias("mark")), "runs")
    return runs


def _named(steps: DataFrame, convs: DataFrame, deepest: int) -> DataFrame:
    """(conv, depth, name) of every prefix of every conversation, the empty one included.

    The cuts of the widest runs are named first. Each is the name of the cut before it and the run
    between; cuts of half that width then lie halfway between two cuts with names.
    """
    runs = _runs(steps, deepest)
    named = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.unhex(F.md5(F.lit("").cast("binary"))).alias("name"))
    for width in sorted(runs, reverse=True):
        halfway = runs[width].filter((F.col("end") / width) % 2 == 1).select("conv", (F.col("end") - width).alias("depth"), "mark")
        cuts = named.join(halfway, ["conv", "depth"])
        named = named.union(land(cuts.select("conv", (F.col("depth") + width).alias("depth"), _digest("name", "mark").alias("name")), "cuts"))
    return named


def _paths(steps: DataFrame, named: DataFrame) -> DataFrame:
    """Per prefix: conv, depth, name, parent (the name one turn shorter), bytes of its last text, last (no longer one)."""
    none = {"name": "binary", "parent": "binary", "bytes": "long", "longer": "boolean"}

    def part(rows: DataFrame, shift: int, **values: Column) -> DataFrame:
        filled = [values.get(name, F.lit(None).cast(kind)).alias(name) for name, kind in none.items()]
        return rows.select("conv", (F.col("depth") + shift).alias("depth"), *filled)

    every = part(named, 0, name=F.col("name"), parent=F.lit(None).cast("binary"))
    every = every.union(part(named, 1, parent=F.col("name"))).union(part(named, -1, longer=F.lit(True)))
    every = every.union(part(steps, 0, bytes=F.col("bytes")))
    paths = every.groupBy("conv", "depth").agg(*[F.max(name).alias(name) for name in none]).filter("name IS NOT NULL")
    return land(paths.select("conv", "depth", "name", "parent", F.coalesce("bytes", F.lit(0)).alias("bytes"), F.col("longer").isNull().alias("last")), "paths")


def _grafted(nodes: DataFrame, paths: DataFrame, deepest: int) -> DataFrame:
    """(depth, name, n_leaves, saved) over each node's subtree.

    Before the step of a width, nodes hold the totals down to the next multiple of that width. Forests
    that hang below odd multiples are then summed and grafted: on the cut prefix and on what lies
    above it, down from the multiple before, along the path of one member.
    """
    sums = [F.sum(name).alias(name) for name in ("n_leaves", "saved")]
    totals = nodes.select("depth", "name", "parent", "n_leaves", "saved")
    ways = land(paths.join(nodes.select("conv").distinct(), "conv", "left_semi").select("conv", "depth", "name", "parent"), "ways")
    members = nodes.select(F.col("conv"), F.col("depth"), F.col("name").alias("cut"))
    for width in (1 << level for level in range(deepest.bit_length())):
        forests = totals.filter((F.col("depth") > width) & ((F.col("depth") - 1) % (2 * width) == width))
        forests = forests.groupBy(F.col("parent").alias("cut"), (F.col("depth") - 1).alias("depth")).agg(*sums)
        forests = forests.join(members, ["depth", "cut"]).select("conv", (F.col("depth") / width).cast("long").alias("block"), "n_leaves", "saved")
        above = ways.filter("depth > 0").withColumn("block", F.ceil(F.col("depth") / width)).join(forests, ["conv", "block"])
        totals = totals.union(land(above.groupBy("depth", "name", "parent").agg(*sums), "grafts"))
    down = totals.groupBy("depth", "name").agg(*sums)
    below = totals.filter("depth = 1").agg(*sums).select(F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("name"), "n_leaves", "saved")
    root = down.filter("depth = 0")
    whole = root.union(below).agg(F.min("depth").alias("depth"), F.max("name").alias("name"), *sums)
    return down.filter("depth > 0").union(whole)


def trie(steps: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes and every sequence's path through it.

    ``steps`` has conv, depth (from 1, without gaps), mark (what turns are compared by) and bytes;
    ``convs`` has every conv, also those without steps. Nodes: conv_id (smallest member), depth, name,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens. A node's turn is that of conv_id at depth.
    Paths: conv, depth, name, last. Without conversations there is no node.
    """
    steps, convs = land(steps, "steps"), land(convs, "convs")
    deepest = steps.agg(F.max("depth")).first()[0] or 0
    paths = _paths(steps, _named(steps, convs, deepest))
    nodes = paths.groupBy("depth", "name").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("parent").alias("parent"), F.max("bytes").alias("bytes")
    )
    nodes = land(nodes, "nodes")
    children = nodes.groupBy("parent", (F.col("depth") - 1).alias("above")).agg(F.count("*").alias("n_children")).filter("above >= 0")
    children = children.select(F.col("above").alias("depth"), F.col("parent").alias("name"), "n_children")
    nodes = nodes.join(children, ["depth", "name"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    leaf, saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("bytes")
    nodes = land(nodes.select("*", leaf.alias("n_leaves"), saved.alias("saved")), "nodes")
    totals = _grafted(nodes, paths, deepest)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    whole = nodes.drop("n_leaves", "saved").join(parents, ["depth", "parent"], "left").join(totals, ["depth", "name"])
    columns = [F.col("conv").alias("conv_id"), "depth", "name", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens")]
    return whole.select(*columns), paths


def end_digests(paths: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) of the nodes where sequences end.

    Ids are joined in ranges of ids, each of bounded length; a digest takes a node's ranges one after
    another, so no node's ids are held together.
    """
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda conv: conv.cast("string"))
    ends = paths.filter("last").groupBy("depth", "name", F.floor(F.col("conv") / IDS_AT_ONCE).alias("range"))
    ends = ends.agg(F.array_join(ids, ",").alias("ids")).repartition("depth", "name").sortWithinPartitions("depth", "name", "range")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for depth, name, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if key == (depth, name):
                    digest.update(b",")
                else:
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (depth, name), hashlib.sha256()
                digest.update(ids.encode())
            yield _digests(done)
        if key:
            yield _digests([(*key, digest.hexdigest())])

    return ends.mapInArrow(run, "depth long, name binary, ends_sha256 string")


def _digests(rows: list[tuple[int, bytes, str]]) -> pa.RecordBatch:
    kinds = {"depth": pa.int64(), "name": pa.binary(), "ends_sha256": pa.string()}
    return pa.RecordBatch.from_pydict({name: pa.array([row[i] for row in rows], kind) for i, (name, kind) in enumerate(kinds.items())})


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations with the digest of the ids that end there.

    Rows without conv_id belong to no conversation and are left out; null roles and texts count as empty;
    other columns are not read. An empty table gives an empty result.
    """
    turns = turns_of(conversations)
    convs = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv")).distinct()
    nodes, paths = trie(rebuilt(turns), convs)
    whole = nodes.join(end_digests(paths), ["depth", "name"], "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def oracle() -> str:
    """``rebuilt_trie`` as SQL: every prefix as a list, crc32 bit by bit."""
    step = "list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(crc, byte))"
    codes = "list_transform(string_split(conv_id::VARCHAR, ''), lambda char: ord(char)::BIGINT)"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), marked AS (
  SELECT conv_id, turn, strlen(text)::BIGINT AS bytes, md5(strlen(role) || ':' || role || text) AS mark FROM turns
), own AS (
  SELECT conv_id, list(struct_pack(mark := mark, bytes := bytes) ORDER BY turn NULLS FIRST, mark) AS turns
  FROM marked GROUP BY conv_id
), heads AS (
  SELECT *, xor(list_reduce({codes}, lambda crc, byte: {step}, 4294967295), 4294967295) % 9 AS head FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.head], []), c.turns[c.head + 1:]) AS turns
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, len(turns) AS n, list_transform(turns, lambda t: t.mark) AS marks,
         list_transform(turns, lambda t: t.bytes) AS sizes, unnest(range(0, len(turns) + 1)) AS depth
  FROM rebuilt
), nodes AS (
  SELECT marks[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(any_value(sizes[depth]), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node
), upward AS (
  SELECT saved, (n_children = 0)::BIGINT AS leaf, node, unnest(range(0, depth + 1)) AS above FROM counted
), totals AS (
  SELECT node[1:above] AS node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM upward GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM counted n JOIN totals t ON t.node = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""
