"""Surrogate keys for dimension members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Members that cut the key space into ranges; what a plan carries along of them is this many keys.
CUTS = 255


def members(rows: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column."""
    return rows.select(column).dropna().distinct()


def number_bounded(
    values: DataFrame, key: str, id_column: str, start: Column | None = None
) -> DataFrame:
    """Ids 1..n in key order, for a member set with a proven bound (catalogue, year range).

    The window has one partition, hence one task; use :func:`number_members` without a bound.
    """
    position = F.row_number().over(Window.orderBy(key))
    return values.select((position + _offset(start)).cast("int").alias(id_column), key)


def number_members(
    values: DataFrame, key: str, id_column: str, start: Column | None = None, cuts: int = CUTS
) -> DataFrame:
    """Ids 1..n in key order for any number of unique members, without a one-task sort.

    The members lowest by a hash cut the key space into ranges of like size; a member's id is its
    position inside its range plus the size of all lower ranges. Cuts and sizes follow from the set
    of members alone, not from its layout, so a recomputed task hands out the same ids and nothing
    has to be written in between. The members are shuffled once for cuts, sizes and positions.
    """
    members = values.select(key)
    lowest = members.orderBy(F.xxhash64(key), key).limit(cuts)
    bounds = lowest.agg(F.collect_list(key)).scalar()
    cuts_below = F.size(F.filter("_cuts", lambda cut: cut <= F.col(key)))
    ranged = members.withColumn("_cuts", bounds).select(key, cuts_below.alias("_range"))
    lower_ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, so at most one more than there are cuts.
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    below = sizes.select(
        F.struct("_range", F.coalesce(F.sum("_size").over(lower_ranges), F.lit(0))).alias("_entry")
    )
    offsets = below.agg(F.map_from_entries(F.collect_list("_entry"))).scalar()
    position = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    id_ = position + F.element_at(offsets, F.col("_range")) + _offset(start)
    return ranged.select(id_.cast("int").alias(id_column), key)


def insert_if_absent(existing: DataFrame, values: DataFrame, key: str, id_column: str) -> DataFrame:
    """Keep every existing ``(id, key)`` row and number the new values after the highest id."""
    highest = existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    known = existing.select(F.col(key).alias("_known"))
    new = members(values, key).join(known, F.col(key) == F.col("_known"), "left_anti")
    return existing.select(id_column, key).unionByName(
        number_members(new, key, id_column, highest)
    )


def _offset(start: Column | None) -> Column:
    return F.lit(0) if start is None else start
