"""The command line, and the options handed to Spark's JDBC source."""

import pytest
from hazardmart.__main__ import main
from hazardmart.plans.load import read_load
from hazardmart.schemas import DISASTER_STAGING, EMERGENCY_STAGING, PROJECT_STAGING, text_schema
from hazardmart.sources.readers import read_csv, read_jdbc
from hazardmart.sources.writers import write_jdbc


def write_csv(path, schema, **values):
    names = schema.fieldNames()
    cells = [f'"{values.get(name, "")}"' for name in names]
    path.write_text(",".join(names) + "\n" + ",".join(cells) + "\n", encoding="utf-8")
    return str(path)


def test_command_line_load(spark, tmp_path):
    disasters = write_csv(
        tmp_path / "disasters.csv",
        DISASTER_STAGING,
        entidad_federativa="chiapas",
        anio="2020.0",
        tipo_fenomeno="GEOLOGICO",
        numero_municipios_corroborados="4",
    )
    emergencies = write_csv(
        tmp_path / "emergencies.csv",
        EMERGENCY_STAGING,
        entidad_federativa="CDMX",
        anio_ocurrencia_evento="2024",
        tipo_fenomeno="Hidrometeorologico",
        poblacion_afectada="1,500",
        costo_total_declaratoria="$2,000.50",
    )
    projects = write_csv(tmp_path / "projects.csv", PROJECT_STAGING, consecutivo="1")
    folder = str(tmp_path / "load")
    main(
        ["--disasters", disasters, "--emergencies", emergencies, "--projects", projects]
        + ["--folder", folder, "--first-year", "2020", "--last-year", "2024"]
    )
    flat = read_load(spark, folder).flat().orderBy("estado").collect()
    assert [(row["estado"], row["anio"], row["municipios_afectados"]) for row in flat] == [
        ("Chiapas", 2020, 4),
        ("Ciudad de México", 2024, 0),
    ]


class Recorder:
    """Stands in for a reader, a writer and their session, and remembers the options."""

    def __init__(self, rows=None):
        self.seen = {}
        self.rows = rows
        self.read = self.write = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def load(self):
        return self.rows

    def save(self):
        self.seen["saved"] = True


def test_jdbc_read_casts_to_text_and_splits(spark):
    recorder = Recorder(spark.createDataFrame([(1, 2020, 1.5)], "no int, anio int, extra double"))
    rows = read_jdbc(
        recorder,
        "jdbc:test:db",
        "staging.disasters",
        text_schema("no anio"),
        {"user": "reader"},
        split=("no", 0, 1000, 8),
    )
    assert rows.dtypes == [("no", "string"), ("anio", "string")]
    assert recorder.seen == {
        "format": "jdbc",
        "url": "jdbc:test:db",
        "dbtable": "staging.disasters",
        "user": "reader",
        "partitionColumn": "no",
        "lowerBound": 0,
        "upperBound": 1000,
        "numPartitions": 8,
    }


def test_jdbc_write_is_batched():
    recorder = Recorder()
    write_jdbc(recorder, "jdbc:test:db", "dim_estado", {"user": "w"}, mode="overwrite")
    assert recorder.seen == {
        "format": "jdbc",
        "url": "jdbc:test:db",
        "dbtable": "dim_estado",
        "truncate": "true",
        "batchsize": 1000,
        "user": "w",
        "mode": "overwrite",
        "saved": True,
    }


def test_csv_with_swapped_header_names_is_refused(spark, tmp_path):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from pyspark.sql.types import StructType

    (tmp_path / "swapped.csv").write_text("b,a\n1,2\n")
    schema = StructType.fromDDL("a string, b string")
    with pytest.raises((PySparkException, Py4JJavaError), match="swapped.csv"):
        read_csv(spark, str(tmp_path), schema, quoted_newlines=False).collect()


def test_repeated_variant_is_refused(spark):
    from dataclasses import replace

    from hazardmart.catalogues import Catalogues
    from hazardmart.operators.quality import DataQualityError
    from hazardmart.plans.load import _check_catalogues

    official = Catalogues.official(spark)
    _check_catalogues(official)
    with pytest.raises(DataQualityError):
        _check_catalogues(replace(official, states=official.states.union(official.states.limit(1))))
