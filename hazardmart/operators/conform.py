"""Conforming values to a catalogue, and telling known values from unknown ones.

A catalogue is a ``(variante, canonico)`` frame with unique variants. None of the joins carries
a broadcast hint: Catalyst broadcasts a catalogue whose known size allows it and otherwise
shuffles, where adaptive execution splits a hot value over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.functions.cleansing import clean_text, title_words

Fallback = Callable[[Column], Column]


def keep_cleaned(cleaned: Column) -> Column:
    """Unknown values pass through as cleaned text."""
    return cleaned


def no_value(cleaned: Column) -> Column:
    """Unknown values become NULL."""
    return F.lit(None).cast("string")


def conform(
    rows: DataFrame, source: str, target: str, catalogue: DataFrame, unknown: Fallback
) -> DataFrame:
    """Add ``target``: the canonical form of ``source``, or ``unknown(cleaned text)``.

    A variant listed with a NULL canonical value is known and yields NULL.
    """
    lookup = catalogue.select(
        F.col("variante").alias("_variant"), F.col("canonico").alias("_canonical")
    )
    known = F.col("_variant").isNotNull()
    return (
        rows.withColumn("_cleaned", clean_text(F.col(source)))
        .join(lookup, F.col("_cleaned") == F.col("_variant"), "left")
        .withColumn(
            target, F.when(known, F.col("_canonical")).otherwise(unknown(F.col("_cleaned")))
        )
        .drop("_cleaned", "_variant", "_canonical")
    )


def conform_state(rows: DataFrame, source: str, target: str, states: DataFrame) -> DataFrame:
    return conform(rows, source, target, states, keep_cleaned)


def conform_phenomenon(
    rows: DataFrame, source: str, target: str, phenomena: DataFrame
) -> DataFrame:
    return conform(rows, source, target, phenomena, title_words)


def conform_event_type(
    rows: DataFrame, source: str, target: str, event_types: DataFrame
) -> DataFrame:
    return conform(rows, source, target, event_types, no_value)


def valid_values(catalogue: DataFrame) -> DataFrame:
    """The canonical values of a catalogue, as column ``_valid``, once per variant."""
    return catalogue.select(F.col("canonico").alias("_valid")).dropna()


def keep_valid(rows: DataFrame, column: str, catalogue: DataFrame) -> DataFrame:
    """Rows whose value is canonical; a NULL value is not."""
    return rows.join(valid_values(catalogue), F.col(column) == F.col("_valid"), "left_semi")


def rejected_values(rows: DataFrame, column: str, catalogue: DataFrame) -> DataFrame:
    """``(valor, n)`` of the values ``keep_valid`` drops, NULL included.

    Rows are counted per value before the join, so a frequent unknown value costs one row.
    """
    counted = rows.groupBy(F.col(column).alias("valor")).agg(F.count("*").alias("n"))
    return counted.join(valid_values(catalogue), F.col("valor") == F.col("_valid"), "left_anti")
