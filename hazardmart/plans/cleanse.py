"""Cleansing of the three staging sources into the common event columns.

A source is described by a :class:`SourceSpec`; one projection plus two catalogue joins turn any
described source into events, so a further source needs a description and no code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmart.catalogues import Catalogues
from hazardmart.functions.cleansing import (
    clean_money,
    clean_number,
    coerce_count,
    coerce_whole,
    coerce_year,
    loss,
)
from hazardmart.operators.conform import conform_phenomenon, conform_state, keep_valid
from hazardmart.operators.quality import stack
from hazardmart.schemas import AMOUNT, EVENTS


@dataclass(frozen=True)
class SourceSpec:
    """Which staging column feeds which event column; a measure without column is zero."""

    event_type: str
    state: str
    year: str
    phenomenon: str
    municipalities: str | None = None
    population: str | None = None
    attended: str | None = None
    cost: str | None = None
    # Text before this mark names the phenomenon, the rest describes it.
    phenomenon_until: str | None = None
    # The source's own row number and the date of the row's last change or publication.
    row: str = "no"
    updated: str = "ultima_fecha_actualizacion"

    def columns(self) -> list[str]:
        """The staging columns the source needs."""
        measures = [self.municipalities, self.population, self.attended, self.cost]
        named = [self.state, self.year, self.phenomenon, *filter(None, measures)]
        return [*named, self.row, self.updated]


# Staging columns of each source.
DISASTERS = SourceSpec(
    event_type="Desastre",
    state="entidad_federativa",
    year="anio",
    phenomenon="tipo_fenomeno",
    municipalities="numero_municipios_corroborados",
)
EMERGENCIES = SourceSpec(
    event_type="Emergencia",
    state="entidad_federativa",
    year="anio_ocurrencia_evento",
    phenomenon="tipo_fenomeno",
    municipalities="numero_municipios_corroborados",
    population="poblacion_afectada",
    attended="poblacion_atendida",
    cost="costo_total_declaratoria",
    updated="fecha_publicacion_declaratoria_dof",
)
PREVENTION = SourceSpec(
    event_type="Preventivo",
    state="entidad_federativa_solicitante",
    year="anio_autorizacion",
    phenomenon="tipo_fenomeno_01",
    population="personas_beneficiadas",
    cost="costo_total_mxn_peso",
    phenomenon_until=" (",
    row="consecutivo",
)

# What a load keeps of a row besides the event: where it came from and which texts it lost.
TRACE = T.StructType(
    [
        T.StructField("fila_origen", T.StringType()),
        T.StructField("actualizado", T.StringType()),
        T.StructField("perdidas", T.ArrayType(T.StringType())),
    ]
)


def to_events(
    raw: DataFrame, spec: SourceSpec, catalogues: Catalogues, keep: Sequence[str | Column] = ()
) -> DataFrame:
    """All rows of a source as events, valid state or not, plus the columns in ``keep``."""
    parsed = [value.alias(name) for name, value in _parsed(spec).items()]
    return _conformed(raw.select(*keep, *parsed), catalogues, raw.select(*keep).columns)


def sources_to_events(
    sources: Sequence[tuple[DataFrame, SourceSpec]], catalogues: Catalogues
) -> DataFrame:
    """All rows of several sources as traced events; the catalogues are joined once, after the union."""
    parsed = stack(
        raw.select(*traced(spec), *[value.alias(name) for name, value in _parsed(spec).items()])
        for raw, spec in sources
    )
    return _conformed(parsed, catalogues, TRACE.fieldNames())


def feed_to_events(
    feed: DataFrame,
    source: str,
    specs: Mapping[str, SourceSpec],
    catalogues: Catalogues,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All rows of one table that holds several sources, as events, in a single scan.

    ``source`` names the column that tells the sources apart and ``specs`` describes the rows of each
    of its values; rows with other values or none are left out. A row is parsed by its own source's
    rules only.
    """
    by_source = {value: _parsed(spec) for value, spec in specs.items()}
    if not by_source:
        raise ValueError("no source is described")

    def own(name: str) -> Column:
        chosen = F
        for value, columns in by_source.items():
            chosen = chosen.when(F.col(source) == value, columns[name])
        return chosen.alias(name)

    names = next(iter(by_source.values()))
    parsed = feed.where(F.col(source).isin(*by_source)).select(*keep, *map(own, names))
    return _conformed(parsed, catalogues, keep)


def _parsed(spec: SourceSpec) -> dict[str, Column]:
    """The values a source's row gives for an event, names not yet conformed."""
    phenomenon = F.col(spec.phenomenon)
    if spec.phenomenon_until:
        phenomenon = F.substring_index(phenomenon, spec.phenomenon_until, 1)
    return {
        "_state": F.col(spec.state),
        "_phenomenon": phenomenon,
        "anio": coerce_year(F.col(spec.year)),
        "tipo_evento": F.lit(spec.event_type),
        "municipios_afectados": _measure(spec.municipalities, coerce_count, "int"),
        "poblacion_afectada": _measure(spec.population, clean_number),
        "poblacion_atendida": _measure(spec.attended, clean_number),
        "costo_total": _measure(spec.cost, clean_money),
        "cantidad_eventos": F.lit(1),
    }


def _conformed(parsed: DataFrame, catalogues: Catalogues, keep: Sequence[str]) -> DataFrame:
    named = conform_state(parsed, "_state", "estado", catalogues.states)
    named = conform_phenomenon(named, "_phenomenon", "fenomeno", catalogues.phenomena)
    return named.select(*keep, *EVENTS.fieldNames())


def lost_texts(spec: SourceSpec) -> Column:
    """``column:reason`` of each staging column whose text became no value, as an array.

    The counts come from the written rows, so a task that runs twice does not count twice.
    """
    parsed = {spec.year: coerce_year, spec.municipalities: coerce_whole}
    parsed |= {spec.population: clean_number, spec.attended: clean_number, spec.cost: clean_money}
    named = [
        F.concat(F.lit(f"{column}:"), loss(F.col(column), parse(F.col(column))))
        for column, parse in parsed.items()
        if column
    ]
    return F.filter(F.array(*named), lambda text: text.isNotNull())


def traced(spec: SourceSpec) -> list[Column]:
    """The trace columns of a staging row, to be kept by :func:`to_events`."""
    values = [F.col(spec.row), F.col(spec.updated), lost_texts(spec)]
    return [value.alias(name) for value, name in zip(values, TRACE.fieldNames())]


def loss_counts(events: DataFrame) -> DataFrame:
    """``(tipo_evento, columna, motivo, n)``: texts that became no value, from traced events."""
    lost = events.select("tipo_evento", F.explode("perdidas").alias("lost"))
    return (
        lost.groupBy("tipo_evento", "lost")
        .agg(F.count("*").alias("n"))
        .select(
            "tipo_evento",
            F.substring_index("lost", ":", 1).alias("columna"),
            F.substring_index("lost", ":", -1).alias("motivo"),
            "n",
        )
    )


def clean_disasters(raw: DataFrame, catalogues: Catalogues, keep: Sequence[str] = ()) -> DataFrame:
    """Disaster declarations of a known state."""
    return keep_valid(to_events(raw, DISASTERS, catalogues, keep), "estado", catalogues.states)


def clean_emergencies(
    raw: DataFrame, catalogues: Catalogues, keep: Sequence[str] = ()
) -> DataFrame:
    """Emergency declarations of a known state."""
    return keep_valid(to_events(raw, EMERGENCIES, catalogues, keep), "estado", catalogues.states)


def clean_projects(raw: DataFrame, catalogues: Catalogues) -> DataFrame:
    """Prevention projects with all their columns; unknown states stay in."""
    cleaned = raw.withColumns(
        {
            "anio_autorizacion": coerce_year(F.col("anio_autorizacion")),
            "personas_beneficiadas": clean_number(F.col("personas_beneficiadas")),
            "costo_total": clean_money(F.col("costo_total_mxn_peso")),
        }
    )
    return conform_state(
        cleaned, "entidad_federativa_solicitante", "estado", catalogues.states
    )


def prevention_events(
    raw: DataFrame, catalogues: Catalogues, keep: Sequence[str] = ()
) -> DataFrame:
    """Prevention projects of a known state as a third kind of event.

    The phenomenon is the phrase before the bracket of the first phenomenon column; people who
    benefit count as affected population.
    """
    return keep_valid(to_events(raw, PREVENTION, catalogues, keep), "estado", catalogues.states)


def _measure(column: str | None, cleaning, kind=AMOUNT) -> Column:
    return F.lit(0).cast(kind) if column is None else cleaning(F.col(column))
