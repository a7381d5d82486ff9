"""Stable ids of rows: the same row has the same id in every load, however the data is laid out."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equal rows that one task writes out at a time.
EQUAL_ROWS = 65_536


def content_id(columns: Sequence[str | Column]) -> Column:
    """63 bits of a digest of the columns' texts; lengths keep apart what concatenation would mix.

    Among n different contents about n * n / 2**64 pairs share an id: 0.05 for a billion rows. The load
    checks for duplicates.
    """
    texts = [(F.col(column) if isinstance(column, str) else column).cast("string") for column in columns]
    marked = [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    number = F.conv(F.substring(F.md5(F.concat(*marked)), 1, 16), 16, 10)
    return (number.cast("decimal(20,0)") % F.lit(Decimal(2**63))).cast("bigint")


def with_row_ids(
    rows: DataFrame, id_column: str, unique_key: Sequence[str] | None = None
) -> DataFrame:
    """Add an id that depends on a row's content and its number among equal rows, on nothing else.

    With ``unique_key``, columns that tell all rows apart, ids are digests of these and no row moves.
    Otherwise equal rows are counted, which hash aggregation does before the shuffle, and written out
    again with numbers from 0: it does not matter which of them gets which. A row that a large part of
    the table repeats is one row in the shuffle, and its copies are written by many tasks.
    """
    if unique_key is not None:
        return rows.withColumn(id_column, content_id(unique_key))
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count("*").alias("_n"))
    few = counted.where(F.col("_n") <= EQUAL_ROWS).withColumn("_first", F.lit(0).cast("bigint"))
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(EQUAL_ROWS).cast("bigint")))
    many = counted.where(F.col("_n") > EQUAL_ROWS).withColumn("_first", blocks).repartition("_first", *names)
    last = F.least(F.col("_first") + EQUAL_ROWS, F.col("_n")) - 1
    numbered = few.unionByName(many).withColumn("_equal", F.explode(F.sequence("_first", last)))
    return numbered.select(*names, content_id([*names, "_equal"]).alias(id_column))
