"""Raw text versions of the test tables, spelled the way real sources misspell them.

Each function cycles through a list of spellings by order key, so all rows stay in and the
clean value behind every spelling is known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmart.catalogues import Catalogues, catalogue_frame
from hazardmart.schemas import AMOUNT
from hazardmart.trial.tables import events, table

PHENOMENA = {
    "AUTOMOBILE": "Automóvil",
    "BUILDING": "Edificio",
    "FURNITURE": "Mueble",
    "SIN DATO": None,
    "N/A": None,
    "": None,
}
EVENT_TYPES = {"F": "Desastre", "O": "Emergencia"}


def catalogues(spark: SparkSession, sf_dir: str) -> Catalogues:
    """States under their name and their ``N<key>`` alias, plus the catalogues above."""
    nation = table(spark, sf_dir, "nation")
    spellings = F.explode(F.array("n_name", F.concat(F.lit("N"), F.col("n_nationkey"))))
    return Catalogues(
        states=nation.select(spellings.alias("variante"), F.col("n_name").alias("canonico")),
        phenomena=catalogue_frame(spark, PHENOMENA),
        event_types=catalogue_frame(spark, EVENT_TYPES),
    )


def state_text(name: Column, number: Column) -> Column:
    spellings = [
        "<name>",
        "<lower>",
        "  <name> ",
        "\t<lower>\n",
        "n<number>",
        "\u00a0<name>\u2003",
        "sin dato",
        None,
    ]
    return spell(spellings, name=name, lower=F.lower(name), number=number.cast("string"))


def year_text(year: Column) -> Column:
    text = year.cast("string")
    spellings = [
        "<year>",
        "<year>.0",
        " <year>\n",
        "<head>.<tail>e3",
        "<head>,<tail>",
        "SD",
        None,
        "<year>",
        "<year>",
    ]
    head, tail = F.substring(text, 1, 1), F.substring(text, 2, 3)
    return spell(spellings, year=text, head=head, tail=tail)


def phenomenon_text(segment: Column) -> Column:
    spellings = [
        "<segment>",
        "<lower>",
        " <segment> ",
        "Sin dato",
        "n/a",
        "",
        " \t ",
        "<segment> (TIPO)-DOS",
        "<lower>/2da fase",
        None,
        "<lower>\r\n",
    ]
    return spell(spellings, segment=segment, lower=F.lower(segment))


def count_text(count: Column) -> Column:
    return spell(["<count>", "<count>.0", " <count>", None, "SD"], count=count.cast("string"))


def number_text(amount: Column) -> Column:
    spellings = [
        "<commas>",
        " <plain> ",
        "<commas> \n",
        "SD",
        "<plain> 000",
        None,
        "<plain>e0",
        "<plain>d",
        "+<plain>",
    ]
    return spell(spellings, plain=amount.cast("string"), commas=F.format_number(amount, 2))


def money_text(amount: Column) -> Column:
    spellings = ["$<commas>", "-", "", "SD", None, "$-", "<plain>"]
    return spell(spellings, plain=amount.cast("string"), commas=F.format_number(amount, 2))


def disasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_of(spark, sf_dir, "F")


def emergencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_of(spark, sf_dir, "O")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_of(spark, sf_dir, "P")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three sources in one table; ``fuente`` tells them apart, and a row fills its own columns."""
    owners: dict[str, list[str]] = {}
    texts: dict[str, Column] = {}
    for status, columns in _texts().items():
        for name, text in columns.items():
            owners.setdefault(name, []).append(status)
            texts[name] = text
    status = F.col("tipo_evento")
    own = [F.when(status.isin(owners[name]), text).alias(name) for name, text in texts.items()]
    return events(spark, sf_dir).select("o_orderkey", status.alias("fuente"), *own)


def _texts() -> dict[str, dict[str, Column]]:
    """The staging columns of each source, by order status; equal names hold equal texts."""
    state = state_text(F.col("estado"), F.col("n_nationkey"))
    year = year_text(F.col("anio"))
    segment = F.col("tipo_fenomeno")
    named = {"entidad_federativa": state, "tipo_fenomeno": phenomenon_text(segment)}
    counted = {"numero_municipios_corroborados": count_text(F.col("municipios_afectados"))}
    affected, attended = number_text(_thousands("poblacion_afectada")), number_text(_thousands("poblacion_atendida"))
    cost = money_text(F.col("costo_total"))
    described = spell(
        ["<lower> (uno, dos)", "sin dato", "<segment>"], segment=segment, lower=F.lower(segment)
    )
    return {
        "F": {**named, **counted, "anio": year},
        "O": {
            **named,
            **counted,
            "anio_ocurrencia_evento": year,
            "poblacion_afectada": affected,
            "poblacion_atendida": attended,
            "costo_total_declaratoria": cost,
        },
        "P": {
            "entidad_federativa_solicitante": state,
            "anio_autorizacion": year,
            "tipo_fenomeno_01": described,
            "personas_beneficiadas": affected,
            "costo_total_mxn_peso": cost,
        },
    }


def spell(spellings: Sequence[str | None], **values: Column) -> Column:
    """The spelling at the order key modulo their number, with ``<name>`` filled in."""
    listed = ", ".join("NULL" if spelling is None else f"'{spelling}'" for spelling in spellings)
    text = F.expr(f"array({listed})[int(o_orderkey % {len(spellings)})]")
    for name, value in values.items():
        text = F.replace(text, F.lit(f"<{name}>"), value)
    return text


def _orders_of(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    texts = [text.alias(name) for name, text in _texts()[status].items()]
    return events(spark, sf_dir).where(F.col("tipo_evento") == status).select("o_orderkey", *texts)


def _thousands(measure: str) -> Column:
    return (F.col(measure) * 1000).cast(AMOUNT)
