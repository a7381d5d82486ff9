"""Catalogue conforming, valid values and rejects."""

from hazardmart.catalogues import PHENOMENA, STATES, Catalogues, catalogue_frame
from hazardmart.operators import conform
from tests.plans import plan_of


def conformed(spark, function, catalogue, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    result = function(rows, "v", "clean", catalogue).orderBy("i").collect()
    return [row["clean"] for row in result]


def test_state_spellings(spark):
    expected = {
        "cdmx": "Ciudad de México",
        "D.F.": "Ciudad de México",
        "Distrito Federal": "Ciudad de México",
        " Ciudad de Mexico\n": "Ciudad de México",
        "MEXICO": "Estado de México",
        "Edo. de Mex.": "Estado de México",
        "Veracruz de Ignacio de la Llave": "Veracruz",
        "Ciudad de Mexico y Estado de Mexico": "CIUDAD DE MEXICO Y ESTADO DE MEXICO",
        "sin dato": "SIN DATO",
        None: None,
    }
    states = Catalogues.official(spark).states
    assert conformed(spark, conform.conform_state, states, expected) == list(expected.values())


def test_phenomenon_spellings(spark):
    expected = {
        "hidrometeorológico": "Hidrometeorológico",
        "GEOLOGICO ": "Geológico",
        "Sin dato": None,
        "N/A": None,
        "": None,
        "  ": None,
        "INCENDIOS FORESTALES": "Incendios Forestales",
        "GEOLOGICO (SISMO)-QUIMICO": "Geologico (Sismo)-Quimico",
        None: None,
    }
    phenomena = Catalogues.official(spark).phenomena
    assert conformed(spark, conform.conform_phenomenon, phenomena, expected) == list(
        expected.values()
    )


def test_event_type_spellings(spark):
    expected = {"desastre": "Desastre", " EMERGENCIA": "Emergencia", "Preventivo": None, None: None}
    types = Catalogues.official(spark).event_types
    assert conformed(spark, conform.conform_event_type, types, expected) == list(expected.values())


def test_catalogues_are_complete(spark):
    assert len(STATES) == 47
    assert len(set(STATES.values())) == 32
    assert {name for name in PHENOMENA.values() if name} == {
        "Hidrometeorológico",
        "Geológico",
        "Incendio Forestal",
    }


def test_accepted_and_rejected_partition_the_input(spark):
    states = Catalogues.official(spark).states
    values = ["Jalisco", "Jalisco", "SIN DATO", "SIN DATO", "SIN DATO", None, "JALISCO"]
    rows = spark.createDataFrame([(v,) for v in values], "estado string")
    accepted = conform.keep_valid(rows, "estado", states)
    rejects = conform.rejected_values(rows, "estado", states).collect()
    rejected = {row["valor"]: row["n"] for row in rejects}
    assert [row["estado"] for row in accepted.collect()] == ["Jalisco", "Jalisco"]
    assert rejected == {"SIN DATO": 3, None: 1, "JALISCO": 1}


def test_semi_join_does_not_repeat_rows_of_a_value_with_many_spellings(spark):
    states = catalogue_frame(spark, {"A": "x", "B": "x", "C": "x", "D": None})
    rows = spark.createDataFrame([("x",), ("x",), ("y",)], "estado string")
    assert conform.keep_valid(rows, "estado", states).count() == 2


def test_small_catalogue_is_broadcast_by_its_known_size(spark):
    rows = spark.range(10).selectExpr("cast(id as string) as v")
    result = conform.conform_state(rows, "v", "estado", Catalogues.official(spark).states)
    assert "BroadcastHashJoin" in plan_of(result)
    assert "SortMergeJoin" not in plan_of(result)
