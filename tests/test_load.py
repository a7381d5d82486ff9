"""Sources, the whole load, its rejects and its quality rules."""

from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hazardmart.catalogues import Catalogues
from hazardmart.operators import analytics, dashboard, grain, quality
from hazardmart.plans import cleanse, star
from hazardmart.plans.events import build_events, with_verdict
from hazardmart.plans.load import Staging, read_cube, read_load, run_load, validate
from hazardmart.schemas import (
    DISASTER_STAGING,
    EMERGENCY_STAGING,
    EVENTS,
    FACT_TABLE,
    MEASURES,
    PROJECT_STAGING,
    STAR_TABLES,
    text_schema,
)
from hazardmart.sources.readers import csv_rejects, read_csv, read_parquet
from hazardmart.sources import publication
from hazardmart.sources.publication import located, publish, published
from hazardmart.sources.writers import write_table
from tests.plans import plan_of

DISASTERS = [
    ("Chiapas", "2018", "Hidrometeorologico", "3"),
    ("CHIAPAS ", "2021.0", "geológico", "SD"),
    ("cdmx", "2023", "Incendios forestales", "2.0"),
    ("Oaxaca", "2017", "Geologico", "1"),
    ("Oaxaca", "2026", "Geologico", "1"),
    ("Oaxaca", "SD", "Geologico", "1"),
    ("sin dato", "2020", "Geologico", "1"),
    (None, "2020", "Geologico", "1"),
    ("Sonora", "2020", "Sin dato", "1"),
]
EMERGENCIES = [
    ("Chiapas", "2022", "Hidrometeorologico", "5", "1,200", "SD", "$2,500.50"),
    ("Veracruz de Ignacio de la Llave", "2025", "GEOLOGICO", None, "SD", "10", "-"),
]
PROJECTS = [
    ("Yucatan", "2022", "Geologico (hundimiento, sismo)", "2,320,898", "100.5"),
    ("sin dato", "2022", "Geologico (sismo)", "5", "1"),
    ("Campeche", "2023", "sin dato", "928,363", "10665668.57"),
]


def staged(spark, schema, columns, rows):
    filled = [dict(zip(columns, row)) for row in rows]
    return spark.createDataFrame(
        [tuple(row.get(name) for name in schema.fieldNames()) for row in filled], schema
    )


@pytest.fixture(scope="module")
def staging(spark):
    common = ["entidad_federativa", "anio", "tipo_fenomeno", "numero_municipios_corroborados"]
    emergency = [
        "entidad_federativa",
        "anio_ocurrencia_evento",
        "tipo_fenomeno",
        "numero_municipios_corroborados",
        "poblacion_afectada",
        "poblacion_atendida",
        "costo_total_declaratoria",
    ]
    project = [
        "entidad_federativa_solicitante",
        "anio_autorizacion",
        "tipo_fenomeno_01",
        "personas_beneficiadas",
        "costo_total_mxn_peso",
    ]
    return Staging(
        disasters=staged(spark, DISASTER_STAGING, common, DISASTERS),
        emergencies=staged(spark, EMERGENCY_STAGING, emergency, EMERGENCIES),
        projects=staged(spark, PROJECT_STAGING, project, PROJECTS),
    )


@pytest.fixture(scope="module")
def load(staging, tmp_path_factory):
    return run_load(staging, f"{tmp_path_factory.mktemp('load')}/run")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_staging_schemas():
    assert [len(s) for s in (DISASTER_STAGING, PROJECT_STAGING, EMERGENCY_STAGING)] == [18, 22, 84]


def test_cleansed_sources_have_the_event_schema(spark, staging):
    catalogues = Catalogues.official(spark)
    disasters = cleanse.clean_disasters(staging.disasters, catalogues)
    emergencies = cleanse.clean_emergencies(staging.emergencies, catalogues)
    for frame in (disasters, emergencies):
        assert frame.dtypes == [(field.name, field.dataType.simpleString()) for field in EVENTS]
    assert disasters.count() == 7
    first = emergencies.where("estado = 'Chiapas'").collect()[0]
    assert first.asDict() == {
        "estado": "Chiapas",
        "anio": 2022,
        "fenomeno": "Hidrometeorológico",
        "tipo_evento": "Emergencia",
        "municipios_afectados": 5,
        "poblacion_afectada": Decimal("1200.00"),
        "poblacion_atendida": None,
        "costo_total": Decimal("2500.50"),
        "cantidad_eventos": 1,
    }


def test_projects_keep_all_columns_and_states(spark, staging):
    projects = cleanse.clean_projects(staging.projects, Catalogues.official(spark))
    assert set(PROJECT_STAGING.fieldNames()) | {"estado", "costo_total"} == set(projects.columns)
    assert projects.count() == 3
    assert {row["estado"] for row in projects.collect()} == {"Yucatán", "SIN DATO", "Campeche"}


def test_year_filter_is_inclusive(spark, staging):
    catalogues = Catalogues.official(spark)
    base = build_events(cleanse.clean_disasters(staging.disasters, catalogues))
    assert sorted(row["anio"] for row in base.collect()) == [2018, 2020, 2021, 2023]


def test_verdicts_cover_every_row(spark, staging):
    catalogues = Catalogues.official(spark)
    events = cleanse.to_events(staging.disasters, cleanse.DISASTERS, catalogues)
    judged = with_verdict(events, catalogues.states)
    counts = {row["verdict"]: row["count"] for row in judged.groupBy("verdict").count().collect()}
    assert counts == {
        "accepted": 3,
        "unknown_state": 2,
        "year_out_of_range": 3,
        "null_phenomenon": 1,
    }


def test_whole_load(spark, staging, load):
    publish(spark, load.folder, [*STAR_TABLES, *dashboard.VIEWS])
    assert load.events.count() == 5
    assert load.rejected.count() == 6
    assert rows_of(load.dimensions.estado) == [
        (1, "Chiapas"),
        (2, "Ciudad de México"),
        (3, "Veracruz"),
    ]
    years = [2018, 2021, 2022, 2023, 2025]
    assert rows_of(load.dimensions.tiempo) == list(enumerate(years, start=1))
    assert rows_of(load.dimensions.fenomeno) == [
        (1, "Geológico"),
        (2, "Hidrometeorológico"),
        (3, "Incendios Forestales"),
    ]
    assert rows_of(load.dimensions.tipo_evento) == [(1, "Desastre"), (2, "Emergencia")]
    assert quality.missing_tables(spark, [*STAR_TABLES, *dashboard.VIEWS]) == []
    assert quality.missing_tables(spark, ["dim_estado", "dim_none"]) == ["dim_none"]
    assert spark.table(FACT_TABLE).count() == 5
    ranking = spark.table("vw_ranking_estados_eventos").orderBy("ranking_total", "estado").collect()
    assert [(row["ranking_total"], row["estado"]) for row in ranking] == [
        (1, "Chiapas"),
        (2, "Ciudad de México"),
        (2, "Veracruz"),
    ]


def test_load_with_prevention(spark, staging, tmp_path):
    load = run_load(
        staging, f"{tmp_path}/prevention", include_prevention=True, consolidated=True
    )
    assert load.fact.count() == load.events.count()
    prevention = load.events.where("tipo_evento = 'Preventivo'").collect()
    assert [(row["estado"], row["fenomeno"]) for row in prevention] == [("Yucatán", "Geológico")]
    assert prevention[0]["poblacion_afectada"] == Decimal("2320898.00")
    assert rows_of(load.dimensions.tipo_evento)[-1] == (3, "Preventivo")


def test_reload_keeps_ids_and_numbers_new_members_last(staging, load, tmp_path):
    same = run_load(staging, f"{tmp_path}/same", previous=load)
    for name, rows in load.dimensions.tables().items():
        assert rows_of(rows) == rows_of(same.dimensions.tables()[name])
    assert rows_of(load.fact) == rows_of(same.fact)

    more = run_load(staging, f"{tmp_path}/more", include_prevention=True, previous=load)
    assert rows_of(more.dimensions.estado)[3:] == [(4, "Yucatán")]
    assert rows_of(more.dimensions.tipo_evento)[2:] == [(3, "Preventivo")]


def test_ids_follow_rows_not_layout(spark, staging, load, tmp_path):
    """A repeated declaration, other partitions and another order: old rows keep their ids."""
    more = staging.disasters.unionByName(staging.disasters.limit(1)).repartition(3, "anio").orderBy(F.desc("anio"))
    again = run_load(Staging(more, staging.emergencies.repartition(2), staging.projects), f"{tmp_path}/again")
    ids = {row["id_evento"] for row in load.fact.collect()}
    new = {row["id_evento"] for row in again.fact.collect()}
    assert len(ids) == 5 and len(new) == 6 and ids < new
    twice = again.fact.unionByName(again.fact.limit(1))
    broken = type(load)(again.folder, again.events, again.rejected, again.dimensions, twice)
    with pytest.raises(quality.DataQualityError, match="duplicate id_evento: 1"):
        validate(broken)


def test_latest_only_strict_and_catalogues_from_a_folder(spark, staging, tmp_path):
    Catalogues.official(spark).write(f"{tmp_path}/catalogues")
    known = Catalogues.read(spark, f"{tmp_path}/catalogues")
    columns = ["no", "entidad_federativa", "anio", "tipo_fenomeno", "ultima_fecha_actualizacion"]
    rows = [
        ("1", "Chiapas", "2018", "Geologico", "2024-01-05"),
        ("2", "Chiapas", "2018", "Geologico", "31/12/2024"),
        ("9", "Chiapas", "2018", "Geologico", "2024-12-31"),
        ("9", "Chiapas", "2018", "Geologico", "2024-12-31"),
        ("3", "Chiapas", "2018", "Geologico", None),
        ("4", "Oaxaca", "2019", "Volcan inactivo", "x"),
    ]
    disasters = staged(spark, DISASTER_STAGING, columns, rows)
    load = run_load(
        Staging(disasters, staging.emergencies, staging.projects),
        f"{tmp_path}/latest",
        catalogues=known,
        strict=True,
        latest_only=True,
    )
    verdicts = {row["verdict"]: row["count"] for row in load.rejected.groupBy("verdict").count().collect()}
    assert verdicts == {"superseded": 4, "unknown_phenomenon": 1}
    kept = spark.read.parquet(located(load.folder, "eventos_conformados"))
    kept = kept.where("verdict = 'accepted' AND tipo_evento = 'Desastre'").collect()
    assert [(row["fila_origen"], row["actualizado"]) for row in kept] == [("9", "2024-12-31")]
    assert load.fact.count() == 3


def test_catalogue_without_its_columns_is_refused(spark, tmp_path):
    spark.createDataFrame([("A", "B")], "variant string, canonico string").write.parquet(f"{tmp_path}/states")
    with pytest.raises(ValueError, match="no column variante"):
        Catalogues.read(spark, str(tmp_path))


def test_losses_are_reported(spark, load):
    losses = spark.read.json(located(load.folder, "reporte_perdidas")).collect()
    assert {(row["tipo_evento"], row["columna"], row["motivo"], row["n"]) for row in losses} == {
        ("Desastre", "anio", "no_number", 1),
        ("Desastre", "numero_municipios_corroborados", "no_number", 1),
        ("Emergencia", "poblacion_atendida", "no_number", 1),
        ("Emergencia", "poblacion_afectada", "no_number", 1),
        ("Emergencia", "costo_total_declaratoria", "no_number", 1),
    }


def test_stored_results_and_both_grains(spark, staging, load):
    detail, cube = load.flat(), read_cube(load)
    for name, result in dashboard.results(detail).items():
        assert rows_of(spark.read.parquet(located(load.folder, name))) == rows_of(result), name
    for analytic in (analytics.top_state_years, analytics.fact_totals, analytics.star_cube):
        assert rows_of(analytic(cube)) == rows_of(analytic(detail))


def test_an_interrupted_publication_shows_one_load_only(spark, staging, load, tmp_path, monkeypatch):
    tables = [*STAR_TABLES, *dashboard.VIEWS]
    root = f"{tmp_path}/loads"
    for name in ("old", "new"):
        for table in tables:
            rows = spark.read.parquet(located(load.folder, table))
            write_table(rows.limit(1 if name == "old" else 2), located(f"{root}/{name}", table))
    publish(spark, f"{root}/old", tables)
    whole = {table: spark.read.parquet(located(load.folder, table)).count() for table in tables}
    shown = {table: spark.table(table).count() for table in tables}
    assert shown == {table: min(n, 1) for table, n in whole.items()}
    assert published(spark, root) == f"{root}/old"
    assert spark.table("dim_estado").columns == ["id_estado", "estado"]

    def stop(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(publication, "_append", stop)
        with pytest.raises(OSError, match="lost"):
            publish(spark, f"{root}/new", tables)
    assert {table: spark.table(table).count() for table in tables} == shown
    publish(spark, f"{root}/new", tables)
    assert {table: spark.table(table).count() for table in tables} == {table: min(n, 2) for table, n in whole.items()}
    assert "PartitionFilters: [isnotnull(load" in plan_of(spark.table(FACT_TABLE))
    publish(spark, f"{root}/old", tables)
    assert {table: spark.table(table).count() for table in tables} == shown


def test_broken_load_is_not_published(spark, staging, load, tmp_path):
    publish(spark, load.folder, STAR_TABLES)
    negative = staging.emergencies.withColumn("poblacion_afectada", F.lit("-5"))
    broken = Staging(staging.disasters, negative, staging.projects)
    with pytest.raises(quality.DataQualityError, match="negative measures: 2"):
        run_load(broken, f"{tmp_path}/bad")
    assert spark.table(FACT_TABLE).where("poblacion_afectada < 0").count() == 0


def test_load_without_any_accepted_row_fails(staging, tmp_path):
    nothing = Staging(*[rows.where("false") for rows in vars(staging).values()])
    with pytest.raises(quality.DataQualityError, match="no row was accepted"):
        run_load(nothing, f"{tmp_path}/empty")


def test_load_folder_must_be_new(staging, load):
    with pytest.raises(AnalysisException, match="(?i)exists"):
        run_load(staging, load.folder)


def test_published_database_views(spark, load):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    publish(spark, load.folder, STAR_TABLES, "published")
    assert quality.missing_tables(spark, STAR_TABLES, "published") == []
    assert spark.table(f"published.{FACT_TABLE}").count() == 5


def test_stored_analytics_equal_live_ones(spark, load):
    for name, result in dashboard.views(load.flat()).items():
        assert rows_of(spark.read.parquet(located(load.folder, name))) == rows_of(result)


def test_reports_are_written(spark, load):
    rejected = spark.read.json(located(load.folder, "reporte_rechazos"))
    assert {(row["verdict"], row["count"]) for row in rejected.collect()} == {
        ("unknown_state", 2),
        ("year_out_of_range", 3),
        ("null_phenomenon", 1),
    }
    metrics = spark.read.json(located(load.folder, "reporte_calidad"))
    assert metrics.where("metric = 'leidos_proyectos'").collect()[0]["texto"] == "3"


def test_orphans_and_duplicates_are_found(spark, staging, load):
    fewer = star.Dimensions(
        load.dimensions.estado.where("id_estado > 1"),
        load.dimensions.tiempo,
        load.dimensions.fenomeno,
        load.dimensions.tipo_evento.unionByName(load.dimensions.tipo_evento),
    )
    broken = type(load)(load.folder, load.events, load.rejected, fewer, load.fact)
    with pytest.raises(quality.DataQualityError) as error:
        validate(broken)
    assert "orphan id_estado: 3" in str(error.value)
    assert "duplicate id_tipo_evento: 2" in str(error.value)
    assert "duplicate tipo_evento: 2" in str(error.value)


def test_consolidated_fact_keeps_all_totals(spark, staging, load):
    detail, consolidated = load.events, grain.consolidate(load.events)
    for measure in MEASURES:
        total = F.sum(measure).cast("decimal(38,2)").alias("n")
        assert detail.agg(total).collect() == consolidated.agg(total).collect()


def test_year_filter_prunes_fact_folders(spark, staging, load):
    one_year = read_load(spark, load.folder).flat().where("anio = 2022")
    assert one_year.count() == 1
    assert "PartitionFilters: [isnotnull(anio" in plan_of(one_year)


def test_fact_is_written_without_moving_rows(spark, load):
    """The accepted events lie in files of one year each; the fact only looks up its keys."""
    accepted = spark.read.parquet(f"{located(load.folder, 'eventos_conformados')}/verdict=accepted")
    years = accepted.groupBy(F.input_file_name().alias("file")).agg(F.countDistinct("anio").alias("n"))
    assert {row["n"] for row in years.collect()} == {1}
    conformed = spark.read.parquet(located(load.folder, "eventos_conformados"))
    folders = {(row["verdict"], row["anio_aceptado"]) for row in conformed.collect()}
    assert all((year is None) == (verdict != "accepted") for verdict, year in folders)
    fact = star.load_fact(load.events, load.dimensions, keep=["anio"])
    assert "Exchange hashpartitioning" not in plan_of(fact)
    assert "Exchange rebalance" not in plan_of(fact)


def test_feed_of_several_sources_equals_the_sources(spark, staging):
    known = Catalogues.official(spark)
    tagged = {"d": (staging.disasters, cleanse.DISASTERS), "e": (staging.emergencies, cleanse.EMERGENCIES)}
    apart = quality.stack(cleanse.to_events(raw, spec, known) for raw, spec in tagged.values())
    rows = [raw.withColumn("origen", F.lit(tag)) for tag, (raw, _) in tagged.items()]
    rows.append(staging.projects.withColumn("origen", F.lit("x")))
    rows.append(staging.disasters.withColumn("origen", F.lit(None).cast("string")))
    feed = rows[0]
    for more in rows[1:]:
        feed = feed.unionByName(more, allowMissingColumns=True)
    specs = {tag: spec for tag, (_, spec) in tagged.items()}
    together = cleanse.feed_to_events(feed, "origen", specs, known)
    assert together.schema.fieldNames() == EVENTS.fieldNames()
    assert sorted(map(str, rows_of(together))) == sorted(map(str, rows_of(apart)))
    counts = quality.tagged_row_counts(feed, "origen", {"desastres": "d", "otros": "nadie"})
    assert {row["source"]: row["n"] for row in counts.collect()} == {"desastres": len(DISASTERS), "otros": 0}
    with pytest.raises(ValueError, match="no source"):
        cleanse.feed_to_events(feed, "origen", {}, known)


def test_star_gives_the_same_analytics_as_the_flat_events(spark, staging, load):
    flat = load.events.withColumnRenamed("fenomeno", "tipo_fenomeno")
    for analytic in [*dashboard.VIEWS.values(), analytics.star_cube, analytics.top_state_years]:
        assert rows_of(analytic(load.flat())) == rows_of(analytic(flat))


def test_quality_reports(spark, staging, load):
    sources = {"desastres": staging.disasters, "emergencias": staging.emergencies}
    report = {
        row["metric"]: (row["value"], row["texto"])
        for row in quality.quality_metrics(quality.row_counts(sources), load.events).collect()
    }
    assert report["leidos_desastres"] == (Decimal("9.00"), "9")
    assert report["registros_fact"] == (Decimal("5.00"), "5")
    assert report["estados"][0] == 3
    assert report["poblacion_afectada"] == (Decimal("1200.00"), "1,200")
    assert report["costo_total"] == (Decimal("2500.50"), "$2,500.50")
    nulls = {row["metric"]: row["value"] for row in quality.integrity_nulls(load.events).collect()}
    assert nulls == {"estado": 0, "anio": 0, "fenomeno": 0, "tipo_evento": 0}


def test_overlong_text_is_counted(spark):
    rows = spark.createDataFrame([("ab", "x"), ("abc", None)], "estado string, tipo_evento string")
    result = quality.overlong_counts(rows, {"estado": 2, "tipo_evento": 5})
    assert rows_of(result) == [("estado", 1), ("tipo_evento", 0)]


def test_csv_with_quoted_commas_and_line_breaks(spark, tmp_path):
    header = ",".join(PROJECT_STAGING.fieldNames())
    blank = [""] * 22
    first, second = list(blank), list(blank)
    first[0], first[1], first[11], first[19] = "1", "Yucatán", '"423,094 \n"', "24613344.0"
    second[0], second[1], second[11] = "2", "sin dato", '"211, 801"'
    second[3] = '"say ""hi"", twice"'
    path = tmp_path / "projects.csv"
    lines = [header, ",".join(first), ",".join(second), ""]
    path.write_text("\n".join(lines), encoding="utf-8")

    raw = read_csv(spark, str(path), PROJECT_STAGING)
    assert raw.count() == 2
    assert raw.where("consecutivo = '2'").collect()[0]["nombre_proyecto"] == 'say "hi", twice'
    projects = cleanse.clean_projects(raw, Catalogues.official(spark))
    cleaned = projects.orderBy("consecutivo").collect()
    assert [row["personas_beneficiadas"] for row in cleaned] == [Decimal("423094.00"), None]
    assert cleaned[0]["costo_total"] == Decimal("24613344.00")


def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path):
    schema = text_schema("a b c")
    (tmp_path / "one.csv").write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x\ny",,z\n', encoding="utf-8")
    (tmp_path / "two.csv").write_text("a,b,c\n7,8,9\nlonely\n", encoding="utf-8")
    rows = read_csv(spark, str(tmp_path), schema)
    assert rows_of(rows) == [("1", "2", "3"), ("7", "8", "9"), ("x\ny", None, "z")]
    assert rows.count() == 3 and sorted(row["c"] for row in rows.select("c").collect()) == ["3", "9", "z"]
    rejects = csv_rejects(spark, str(tmp_path), schema)
    assert rows_of(rejects) == [("one.csv", "4,5"), ("one.csv", "6,7,8,9"), ("two.csv", "lonely")]
    counted = rejects.groupBy("archivo").count()
    assert rows_of(counted) == [("one.csv", 2), ("two.csv", 1)]


def test_a_missing_parquet_column_is_refused_if_needed(spark, tmp_path):
    schema = text_schema("a b")
    spark.createDataFrame([("1",)], "a string").write.parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError, match="no column b"):
        read_parquet(spark, f"{tmp_path}/t", schema)
    assert rows_of(read_parquet(spark, f"{tmp_path}/t", schema, required=["a"])) == [("1", None)]


def test_sketches_of_loads_can_be_united(spark):
    one = spark.range(0, 30_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("few"))
    other = spark.range(20_000, 50_000).select(F.col("id").cast("string").alias("k"), F.lit("y").alias("few"))
    parts = [quality.distinct_sketches(rows, ["k", "few"]) for rows in (one, other)]
    united = dict(rows_of(quality.distinct_estimates(quality.stack(parts))))
    whole = dict(rows_of(quality.distinct_estimates(quality.distinct_sketches(one.union(other), ["k", "few"]))))
    assert united["few"] == whole["few"] == 2
    assert abs(united["k"] - 50_000) < 5 * 0.016 * 50_000 and abs(united["k"] - whole["k"]) < 0.05 * 50_000


def test_partitioned_parquet_round_trip(spark, staging, tmp_path):
    path = f"{tmp_path}/staging"
    write_table(staging.disasters, path, partition_by=["anio"])
    back = read_parquet(spark, path, DISASTER_STAGING)
    assert back.count() == len(DISASTERS)
    write_table(staging.disasters.limit(2), path)
    assert read_parquet(spark, path, DISASTER_STAGING).count() == 2
