"""Consolidation of event rows: to the documented fact grain, or to one latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardmart.schemas import AMOUNT_SUM, EVENT_KEYS, MEASURES

AMOUNTS = ["poblacion_afectada", "poblacion_atendida", "costo_total"]


def consolidate(
    events: DataFrame, keys: Sequence[str] = tuple(EVENT_KEYS), more: Sequence[str] = ()
) -> DataFrame:
    """One row per key combination; ``cantidad_eventos`` counts the merged source events.

    ``more`` names further whole numbers to add up.
    """
    sums = [
        F.sum(name).cast(AMOUNT_SUM if name in AMOUNTS else "bigint").alias(name)
        for name in [*MEASURES, *more]
    ]
    return events.groupBy(*keys).agg(*sums)


def latest_per_key(events: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under a total ``order``.

    Few keys share very many rows here. Catalyst turns ``row_number() = 1`` into a group limit
    that runs before the shuffle, so each task sends at most one row per key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return events.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
