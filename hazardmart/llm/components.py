"""Connected components of links between ids, as joins and aggregations of links only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmart.sources.landed import land


def _stars(links: DataFrame) -> DataFrame:
    """One round: every id is linked to the smallest id among its neighbours, in both directions.

    ``links`` has columns ``node`` and ``root`` with root < node, and so has the result.
    """
    turned = links.select(F.col("root").alias("node"), F.col("node").alias("root"))
    both = links.select("node", "root").union(turned)
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    large = both.join(least, "node").filter("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
    large = large.distinct()
    least = large.groupBy("node").agg(F.min("root").alias("least"))
    below = large.join(least, "node").filter("root > least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return below.union(least.select("node", F.col("least").alias("root"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every id has one root, which has none itself."""
    roots = F.create_map("node", F.lit(1), "root", F.lit(0))  # root < node
    ends = links.select(F.explode(roots).alias("id", "roots"))
    seen = ends.groupBy("id").agg(F.sum("roots").alias("roots"), F.min("roots").alias("least"))
    return not seen.filter("roots > 1 OR (roots = 1 AND least = 0)").take(1)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable id) of every id that a link names.

    ``links`` has two id columns; order, repetition and links of an id to itself do not matter.
    Each round is written to the shared folder, so that a lost executor costs one round at most.
    """
    one, other = (F.col(name) for name in links.columns)
    current = links.select(F.greatest(one, other).alias("node"), F.least(one, other).alias("root"))
    current = land(current.filter("root < node").distinct(), "links")
    while not _settled(current):
        current = land(_stars(current), "links")
    roots = current.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
    return current.select("node", F.col("root").alias("component")).union(roots)
