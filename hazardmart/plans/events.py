"""The event table: union of the cleansed sources, and the rows that cannot enter it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmart.operators.conform import valid_values
from hazardmart.operators.grain import latest_per_key
from hazardmart.operators.quality import stack
from hazardmart.periods import YEARS, YearRange
from hazardmart.schemas import EVENT_ID

ACCEPTED = "accepted"
UNKNOWN_STATE = "unknown_state"
YEAR_OUT_OF_RANGE = "year_out_of_range"
NULL_PHENOMENON = "null_phenomenon"
UNKNOWN_PHENOMENON = "unknown_phenomenon"
UNKNOWN_TYPE = "unknown_type"
SUPERSEDED = "superseded"


def build_events(*cleansed: DataFrame, years: YearRange = YEARS) -> DataFrame:
    """One row per declaration inside the year range; prevention joins in when passed."""
    return stack(cleansed).where(years.holds(F.col("anio")))


def in_year_range(judged: DataFrame) -> DataFrame:
    """The judged rows that :func:`build_events` keeps of valid ones: a NULL phenomenon stays in."""
    return judged.where(F.col("verdict").isin(ACCEPTED, NULL_PHENOMENON)).drop("verdict")


def with_latest(judged: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of the accepted rows with equal ``keys``, the first under a total ``order`` stays accepted.

    The others get the verdict ``superseded``. The first ones are found by a group limit before the
    shuffle and marked by their ids, so rows with equal keys are never brought together. ``judged`` is
    read twice; pass a written table.
    """
    accepted = judged.where(F.col("verdict") == ACCEPTED)
    latest = latest_per_key(accepted, keys, order).select(F.col(EVENT_ID).alias("_latest"))
    marked = judged.join(latest, F.col(EVENT_ID) == F.col("_latest"), "left")
    older = (F.col("verdict") == ACCEPTED) & F.col("_latest").isNull()
    return marked.withColumn("verdict", F.when(older, SUPERSEDED).otherwise(F.col("verdict"))).drop("_latest")


def with_verdict(
    events: DataFrame,
    states: DataFrame,
    years: YearRange = YEARS,
    phenomena: DataFrame | None = None,
    event_types: DataFrame | None = None,
) -> DataFrame:
    """Add ``verdict``: ``accepted`` or the first reason why a row cannot be loaded.

    Rejected rows are kept and reported instead of dropped; a NULL phenomenon would break the
    NOT NULL key of the fact table. A catalogue of phenomena or types, if given, makes their values
    a condition too; without it unlisted ones pass.
    """
    judged, found = events, {}
    for column, catalogue in {"estado": states, "fenomeno": phenomena, "tipo_evento": event_types}.items():
        if catalogue is not None:
            found[column] = f"_valid_{column}"
            known = valid_values(catalogue).distinct().withColumnRenamed("_valid", found[column])
            judged = judged.join(known, F.col(column) == F.col(found[column]), "left")

    def unknown(column: str) -> Column:
        return F.col(found[column]).isNull() if column in found else F.lit(False)

    verdict = (
        F.when(unknown("estado"), UNKNOWN_STATE)
        .when(~F.coalesce(years.holds(F.col("anio")), F.lit(False)), YEAR_OUT_OF_RANGE)
        .when(F.col("fenomeno").isNull(), NULL_PHENOMENON)
        .when(unknown("fenomeno"), UNKNOWN_PHENOMENON)
        .when(unknown("tipo_evento"), UNKNOWN_TYPE)
        .otherwise(ACCEPTED)
    )
    return judged.withColumn("verdict", verdict).drop(*found.values())
