"""Catalogues that map the spellings found in the sources to one canonical name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# State spellings (cleaned text -> official name).
STATES: dict[str, str | None] = {
    "AGUASCALIENTES": "Aguascalientes",
    "BAJA CALIFORNIA": "Baja California",
    "BAJA CALIFORNIA SUR": "Baja California Sur",
    "CAMPECHE": "Campeche",
    "CHIAPAS": "Chiapas",
    "CHIHUAHUA": "Chihuahua",
    "CIUDAD DE MEXICO": "Ciudad de México",
    "CIUDAD DE MÉXICO": "Ciudad de México",
    "CDMX": "Ciudad de México",
    "DISTRITO FEDERAL": "Ciudad de México",
    "D.F.": "Ciudad de México",
    "COAHUILA": "Coahuila",
    "COAHUILA DE ZARAGOZA": "Coahuila",
    "COLIMA": "Colima",
    "DURANGO": "Durango",
    "GUANAJUATO": "Guanajuato",
    "GUERRERO": "Guerrero",
    "HIDALGO": "Hidalgo",
    "JALISCO": "Jalisco",
    "MEXICO": "Estado de México",
    "ESTADO DE MEXICO": "Estado de México",
    "ESTADO DE MÉXICO": "Estado de México",
    "EDO. DE MEX.": "Estado de México",
    "MICHOACAN": "Michoacán",
    "MICHOACÁN": "Michoacán",
    "MICHOACAN DE OCAMPO": "Michoacán",
    "MORELOS": "Morelos",
    "NAYARIT": "Nayarit",
    "NUEVO LEON": "Nuevo León",
    "NUEVO LEÓN": "Nuevo León",
    "OAXACA": "Oaxaca",
    "PUEBLA": "Puebla",
    "QUERETARO": "Querétaro",
    "QUERÉTARO": "Querétaro",
    "QUINTANA ROO": "Quintana Roo",
    "SAN LUIS POTOSI": "San Luis Potosí",
    "SAN LUIS POTOSÍ": "San Luis Potosí",
    "SINALOA": "Sinaloa",
    "SONORA": "Sonora",
    "TABASCO": "Tabasco",
    "TAMAULIPAS": "Tamaulipas",
    "TLAXCALA": "Tlaxcala",
    "VERACRUZ": "Veracruz",
    "VERACRUZ DE IGNACIO DE LA LLAVE": "Veracruz",
    "YUCATAN": "Yucatán",
    "YUCATÁN": "Yucatán",
    "ZACATECAS": "Zacatecas",
}

# Phenomenon spellings; None marks text that stands for "no data".
PHENOMENA: dict[str, str | None] = {
    "HIDROMETEOROLOGICO": "Hidrometeorológico",
    "HIDROMETEOROLÓGICO": "Hidrometeorológico",
    "GEOLOGICO": "Geológico",
    "GEOLÓGICO": "Geológico",
    "INCENDIO FORESTAL": "Incendio Forestal",
    "SIN DATO": None,
    "N/A": None,
    "": None,
}

# Declaration types.
EVENT_TYPES: dict[str, str | None] = {
    "DESASTRE": "Desastre",
    "EMERGENCIA": "Emergencia",
}

CATALOGUE_SCHEMA = pa.schema([("variante", pa.string()), ("canonico", pa.string())])


def catalogue_frame(spark: SparkSession, mapping: Mapping[str, str | None]) -> DataFrame:
    """``(variante, canonico)`` rows of a mapping.

    Built from Arrow so that Catalyst knows the exact size of the relation and decides from it
    whether to broadcast; an outsized catalogue falls back to a shuffled join.
    """
    rows = {"variante": list(mapping), "canonico": list(mapping.values())}
    return spark.createDataFrame(pa.table(rows, schema=CATALOGUE_SCHEMA))


@dataclass(frozen=True)
class Catalogues:
    """The catalogues a load conforms against."""

    states: DataFrame
    phenomena: DataFrame
    event_types: DataFrame

    @classmethod
    def official(cls, spark: SparkSession) -> Catalogues:
        return cls(
            states=catalogue_frame(spark, STATES),
            phenomena=catalogue_frame(spark, PHENOMENA),
            event_types=catalogue_frame(spark, EVENT_TYPES),
        )

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Catalogues:
        """Catalogues kept as Parquet tables ``states``, ``phenomena`` and ``event_types`` in a folder.

        Each has the columns ``variante`` and ``canonico``, so that variants are added without code.
        """
        frames = {}
        for name in ("states", "phenomena", "event_types"):
            rows = spark.read.parquet(f"{folder}/{name}")
            missing = {"variante", "canonico"} - set(rows.columns)
            if missing:
                raise ValueError(f"{folder}/{name} has no column {', '.join(sorted(missing))}")
            frames[name] = rows.select(F.col("variante").cast("string"), F.col("canonico").cast("string"))
        return cls(**frames)

    def write(self, folder: str) -> None:
        """Write the catalogues where :meth:`read` finds them."""
        for name, rows in vars(self).items():
            rows.write.parquet(f"{folder}/{name}")
