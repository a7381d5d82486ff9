"""The star schema: dimensions, fact table and the flat view over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmart.operators.keys import members, number_bounded, number_members
from hazardmart.schemas import DIMENSION_KEYS, FACT_KEYS, MEASURES
from hazardmart.sources.landed import land

# Declaration types in id order; the third one is optional.
EVENT_TYPES = ["Desastre", "Emergencia"]
EVENT_TYPES_WITH_PREVENTION = [*EVENT_TYPES, "Preventivo"]

# Event column behind each dimension whose natural key has another name.
EVENT_COLUMN = {"tipo_fenomeno": "fenomeno"}


@dataclass(frozen=True)
class Dimensions:
    """The four dimensions, each an ``(id, natural key)`` frame."""

    estado: DataFrame
    tiempo: DataFrame
    fenomeno: DataFrame
    tipo_evento: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(
            zip(DIMENSION_KEYS, (self.estado, self.tiempo, self.fenomeno, self.tipo_evento))
        )


def member_sets(events: DataFrame) -> DataFrame:
    """Distinct state, year, phenomenon and type combinations, landed.

    One pass over the events serves all dimensions, and the written size tells Catalyst that
    the dimensions derived from it are small enough to broadcast, or that they are not.
    """
    return land(events.select("estado", "anio", "fenomeno", "tipo_evento").distinct(), "members")


def dim_state(events: DataFrame) -> DataFrame:
    """States in name order; the catalogue bounds them."""
    return number_bounded(members(events, "estado"), "estado", "id_estado")


def dim_time(events: DataFrame) -> DataFrame:
    """Years in order; the year range bounds them."""
    return number_bounded(members(events, "anio"), "anio", "id_tiempo")


def dim_phenomenon(events: DataFrame) -> DataFrame:
    """Phenomena in name order; unlisted text passes through, so there is no bound."""
    named = events.select(F.col("fenomeno").alias("tipo_fenomeno"))
    return number_members(members(named, "tipo_fenomeno"), "tipo_fenomeno", "id_fenomeno")


def dim_event_type(spark: SparkSession, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Declared types, numbered in the order given."""
    rows = pa.table(
        {
            "id_tipo_evento": pa.array(range(1, len(types) + 1), pa.int32()),
            "tipo_evento": pa.array(types, pa.string()),
        }
    )
    return spark.createDataFrame(rows)


def build_dimensions(events: DataFrame, types: Sequence[str] = EVENT_TYPES) -> Dimensions:
    combinations = member_sets(events)
    return Dimensions(
        estado=dim_state(combinations),
        tiempo=dim_time(combinations),
        fenomeno=dim_phenomenon(combinations),
        tipo_evento=dim_event_type(events.sparkSession, types),
    )


def load_fact(events: DataFrame, dimensions: Dimensions, keep: Sequence[str] = ()) -> DataFrame:
    """Events with their natural keys replaced by surrogate keys.

    Left joins on unique keys neither drop nor repeat a row; an unresolved key stays NULL for
    the quality checks. A missing event count means one event.
    """
    keyed = events
    for table, dimension in dimensions.tables().items():
        id_column, natural_key = DIMENSION_KEYS[table]
        lookup = dimension.select(id_column, F.col(natural_key).alias("_member"))
        event_key = F.col(EVENT_COLUMN.get(natural_key, natural_key))
        keyed = keyed.join(lookup, event_key == F.col("_member"), "left").drop("_member")
    return keyed.withColumn(
        "cantidad_eventos", F.coalesce("cantidad_eventos", F.lit(1))
    ).select(*keep, *FACT_KEYS, *MEASURES)


def flat_events(fact: DataFrame, dimensions: Dimensions) -> DataFrame:
    """The view all analytics read: fact rows with the names of their dimension members.

    A natural key the fact carries itself needs no join; for the year, the partition column of
    a loaded fact, this lets a filter on the view skip whole folders.
    """
    joined = fact
    for table, dimension in dimensions.tables().items():
        id_column, natural_key = DIMENSION_KEYS[table]
        if natural_key not in fact.columns:
            joined = joined.join(dimension, id_column)
    return joined.drop(*FACT_KEYS)
