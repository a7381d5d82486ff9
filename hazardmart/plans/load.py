"""The whole load: cleanse, reject, build the star, check it, publish it.

Each load has a name of its own, the last part of its folder, and is published only after its checks
passed, so a failed load leaves the previous one in place (see ``sources.publication``). The tables written in between also cut lineage:
a lost executor costs the running stage, not the load.

The fact is scanned once for all published analytics: they are sums, so they are computed from
its consolidation to one row per state, year, phenomenon and type, and stored next to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmart.catalogues import Catalogues
from hazardmart.operators.dashboard import RESULTS, VIEWS, results, views
from hazardmart.operators.grain import AMOUNTS, consolidate
from hazardmart.operators.keys import insert_if_absent
from hazardmart.operators.quality import (
    DataQualityError,
    distinct_sketches,
    duplicate_count,
    fact_checks,
    integrity_nulls,
    null_counts,
    overlong_counts,
    quality_metrics,
    require_zero,
    row_counts,
    stack,
    tagged_row_counts,
)
from hazardmart.operators.row_ids import with_row_ids
from hazardmart.periods import PERIODS, YEARS, Periods, YearRange
from hazardmart.plans.cleanse import (
    DISASTERS,
    EMERGENCIES,
    PREVENTION,
    TRACE,
    loss_counts,
    sources_to_events,
)
from hazardmart.plans.events import ACCEPTED, with_latest, with_verdict
from hazardmart.plans.star import (
    EVENT_COLUMN,
    EVENT_TYPES,
    EVENT_TYPES_WITH_PREVENTION,
    Dimensions,
    build_dimensions,
    flat_events,
    load_fact,
    member_sets,
)
from hazardmart.schemas import (
    AMOUNT_SUM,
    DIMENSION_KEYS,
    EVENT_ID,
    EVENT_KEYS,
    EVENTS,
    FACT_KEYS,
    FACT_TABLE,
    MEASURES,
    STAR_TABLES,
    TEXT_LENGTHS,
)
from hazardmart.sources.landed import land
from hazardmart.sources.publication import located, publish
from hazardmart.sources.writers import write_report, write_table

EVENT_FOLDER = "eventos_conformados"
CUBE_FOLDER = "eventos_consolidados"
SKETCH_FOLDER = "bocetos"
REPORT_FOLDER = "reporte"
# Partition column of the conformed events: the year of accepted rows.
YEAR_FOLDER = "anio_aceptado"


@dataclass(frozen=True)
class Staging:
    """The three raw sources."""

    disasters: DataFrame
    emergencies: DataFrame
    projects: DataFrame


@dataclass(frozen=True)
class Load:
    """A finished load, read back from its folder."""

    folder: str
    events: DataFrame
    rejected: DataFrame
    dimensions: Dimensions
    fact: DataFrame

    def flat(self) -> DataFrame:
        return flat_events(self.fact, self.dimensions)


def _read_conformed(spark: SparkSession, folder: str) -> DataFrame:
    named = [
        T.StructField(EVENT_ID, T.LongType()),
        T.StructField("verdict", T.StringType()),
        T.StructField(YEAR_FOLDER, T.IntegerType()),
    ]
    schema = T.StructType([*EVENTS, *TRACE, *named])
    return spark.read.schema(schema).parquet(located(folder, EVENT_FOLDER)).drop(YEAR_FOLDER)


def _accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where(F.col("verdict") == ACCEPTED)


def read_load(spark: SparkSession, folder: str) -> Load:
    conformed = _read_conformed(spark, folder)
    tables = {name: spark.read.parquet(located(folder, name)) for name in STAR_TABLES}
    return Load(
        folder=folder,
        events=_accepted(conformed).select(*EVENTS.fieldNames()),
        rejected=conformed.where(F.col("verdict") != ACCEPTED),
        dimensions=Dimensions(*[tables[name] for name in DIMENSION_KEYS]),
        fact=tables[FACT_TABLE],
    )


def run_load(
    staging: Staging,
    folder: str,
    catalogues: Catalogues | None = None,
    years: YearRange = YEARS,
    periods: Periods = PERIODS,
    include_prevention: bool = False,
    consolidated: bool = False,
    previous: Load | None = None,
    database: str | None = None,
    strict: bool = False,
    latest_only: bool = False,
) -> Load:
    """Run one load into ``folder``, which must be new, and publish it.

    Without ``previous`` the dimensions are numbered afresh; with it, members the previous load
    knows keep their ids and new ones are appended. ``consolidated`` loads the fact with one row
    per state, year, phenomenon and type instead of one per declaration; all sums stay the same.
    ``strict`` also rejects phenomena and types that the catalogues do not list. ``latest_only`` keeps
    the row changed last (then the one with the highest row number) of each state, year and phenomenon.
    """
    spark = staging.disasters.sparkSession
    catalogues = catalogues or Catalogues.official(spark)
    _check_catalogues(catalogues)
    sources = [(staging.disasters, DISASTERS), (staging.emergencies, EMERGENCIES)]
    types = EVENT_TYPES
    if include_prevention:
        sources.append((staging.projects, PREVENTION))
        types = EVENT_TYPES_WITH_PREVENTION

    events = sources_to_events(sources, catalogues)
    listed = (catalogues.phenomena, _types(catalogues, types)) if strict else ()
    judged = with_verdict(with_row_ids(events, EVENT_ID), catalogues.states, years, *listed)
    if latest_only:
        judged = with_latest(land(judged, "judged"), LATEST_KEYS, _latest_first())
    # Clustered as the fact will be, so that its write moves no row; rejects have no year folder.
    year = F.when(F.col("verdict") == ACCEPTED, F.col("anio"))
    clustered = judged.withColumn(YEAR_FOLDER, year)
    write_table(clustered, located(folder, EVENT_FOLDER), ["verdict", YEAR_FOLDER], mode="error")
    accepted = _accepted(_read_conformed(spark, folder)).drop("verdict")
    if accepted.isEmpty():
        raise DataQualityError("no row was accepted")

    dimensions = (
        build_dimensions(accepted, types)
        if previous is None
        else _extend(previous.dimensions, accepted)
    )
    for name, rows in dimensions.tables().items():
        write_table(rows, located(folder, name), mode="error")
    written = Dimensions(*[spark.read.parquet(located(folder, name)) for name in DIMENSION_KEYS])

    # The year travels along as the partition column, so year filters prune folders.
    grained = accepted
    if consolidated:
        grained = with_row_ids(consolidate(accepted), EVENT_ID, unique_key=list(EVENT_KEYS))
    fact = load_fact(grained, written, keep=[EVENT_ID, "anio"])
    # One type for every grain: published views read the loads of one table alike.
    wide = {name: F.col(name).cast(AMOUNT_SUM if name in AMOUNTS else "bigint") for name in MEASURES}
    fact = fact.withColumns(wide)
    # Consolidated rows come from a shuffle by other keys; the others lie in files of one year each.
    write_table(fact, located(folder, FACT_TABLE), ["anio"], mode="error", clustered=not consolidated)

    load = read_load(spark, folder)
    validate(load)
    _write_analytics(load, periods)
    _write_reports(load, staging, include_prevention)
    publish(spark, folder, [*STAR_TABLES, *VIEWS, *RESULTS], database)
    return load


LATEST_KEYS = ["estado", "anio", "fenomeno"]


def _latest_first() -> list[Column]:
    """A total order of the rows of a key; dates are ISO or day/month/year texts."""
    changed = F.col("actualizado")
    date = F.coalesce(changed.try_cast("date"), F.try_to_date(changed, "d/M/yyyy"))
    number = F.col("fila_origen").try_cast("decimal(20,0)")
    return [F.desc_nulls_last(date), F.desc_nulls_last(number), F.asc(EVENT_ID)]


def _types(catalogues: Catalogues, declared: list[str]) -> DataFrame:
    """The catalogue's types, of those that the load declares."""
    return catalogues.event_types.where(F.col("canonico").isin(declared))


def _check_catalogues(catalogues: Catalogues) -> None:
    """Refuse a catalogue that lists a variant twice: each event with it would be loaded twice."""
    frames = {
        "states": catalogues.states,
        "phenomena": catalogues.phenomena,
        "event types": catalogues.event_types,
    }
    require_zero(
        stack(
            duplicate_count(frame, ["variante"], f"repeated variant of {name}")
            for name, frame in frames.items()
        )
    )


def validate(load: Load) -> None:
    """Check every declared constraint; raise before anything is published."""
    tables = load.dimensions.tables()
    by_key = {DIMENSION_KEYS[table][0]: rows for table, rows in tables.items()}
    checks = [
        fact_checks(load.fact, by_key, list(MEASURES)),
        duplicate_count(load.fact, [EVENT_ID], f"duplicate {EVENT_ID}"),
    ]
    for table, rows in tables.items():
        id_column, natural_key = DIMENSION_KEYS[table]
        checks += [
            duplicate_count(rows, [id_column], f"duplicate {id_column}"),
            duplicate_count(rows, [natural_key], f"duplicate {natural_key}"),
            null_counts(rows, [id_column, natural_key]),
        ]
        if natural_key in TEXT_LENGTHS:
            checks.append(overlong_counts(rows, {natural_key: TEXT_LENGTHS[natural_key]}))
    require_zero(stack(checks))


def read_cube(load: Load) -> DataFrame:
    """The fact's sums per state, year, phenomenon and type, and its rows as ``registros``."""
    return load.fact.sparkSession.read.parquet(located(load.folder, CUBE_FOLDER))


def _write_analytics(load: Load, periods: Periods) -> None:
    # Summed per surrogate key first, so that only the few consolidated rows look up names.
    counted = load.fact.withColumn("registros", F.lit(1).cast("bigint"))
    by_key = consolidate(counted, [*FACT_KEYS, "anio"], more=["registros"])
    named = flat_events(by_key, load.dimensions)
    write_table(named, located(load.folder, CUBE_FOLDER), mode="error")
    cube = read_cube(load)
    for name, result in {**views(cube, periods), **results(cube, periods)}.items():
        write_table(result, located(load.folder, name), mode="error")


def _write_reports(load: Load, staging: Staging, include_prevention: bool) -> None:
    # Every row of a loaded source is among the conformed ones; only those not loaded are read again.
    conformed = _read_conformed(load.fact.sparkSession, load.folder)
    names = {"desastres": DISASTERS, "emergencias": EMERGENCIES}
    if include_prevention:
        names["proyectos"] = PREVENTION
    types = {name: spec.event_type for name, spec in names.items()}
    read = tagged_row_counts(conformed, "tipo_evento", types)
    if not include_prevention:
        read = read.unionByName(row_counts({"proyectos": staging.projects}))
    reports = {
        "calidad": quality_metrics(read, read_cube(load).withColumnRenamed("tipo_fenomeno", "fenomeno")),
        # Over all conformed rows: the accepted ones cannot hold a null by their verdict.
        "integridad": integrity_nulls(conformed),
        "rechazos": load.rejected.groupBy("tipo_evento", "verdict").count(),
        "perdidas": loss_counts(conformed),
    }
    for name, rows in reports.items():
        write_report(rows, located(load.folder, f"{REPORT_FOLDER}_{name}"))
    sketches = distinct_sketches(load.events, ["estado", "fenomeno", "tipo_evento"])
    write_table(sketches, located(load.folder, SKETCH_FOLDER), mode="error")


def _extend(existing: Dimensions, events: DataFrame) -> Dimensions:
    combinations = member_sets(events)
    extended = []
    for table, rows in existing.tables().items():
        id_column, natural_key = DIMENSION_KEYS[table]
        column = EVENT_COLUMN.get(natural_key, natural_key)
        values = combinations.select(F.col(column).alias(natural_key))
        extended.append(insert_if_absent(rows, values, natural_key, id_column))
    return Dimensions(*extended)
