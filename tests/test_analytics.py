"""Analytics on hand-made events, edge case by edge case."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hazardmart.operators import analytics, dashboard, grain
from hazardmart.periods import Periods

SCHEMA = (
    "estado string, anio int, tipo_fenomeno string, tipo_evento string, municipios_afectados int,"
    " poblacion_afectada decimal(18,2), poblacion_atendida decimal(18,2),"
    " costo_total decimal(18,2), cantidad_eventos int"
)


def events(spark, *counts):
    """``(state, year, phenomenon, type, events)`` rows, each event with fixed measures."""
    rows = [
        (state, year, phenomenon, kind, 2, Decimal("10.25"), Decimal("1"), Decimal("1000000"), 1)
        for state, year, phenomenon, kind, n in counts
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def by(result, *keys):
    return {tuple(row[key] for key in keys): row for row in result.collect()}


def test_period_comparison_trends(spark):
    result = by(
        analytics.period_comparison(
            events(
                spark,
                ("A", 2020, "f", "Desastre", 1),
                ("A", 2022, "f", "Desastre", 3),
                ("B", 2021, "f", "Desastre", 2),
                ("C", 2019, "f", "Desastre", 1),
            )
        ),
        "estado",
    )
    assert result[("A",)].asDict() == {
        "estado": "A",
        "tipo_evento": "Desastre",
        "tipo_fenomeno": "f",
        "eventos_pandemia": 1,
        "eventos_postpandemia": 3,
        "total_historico": 4,
        "municipios_postpandemia": 6,
        "poblacion_postpandemia": 31,
        "diferencia_absoluta": 2,
        "tendencia": "AUMENTO",
    }
    assert result[("B",)]["tendencia"] == "DISMINUCIÓN"
    assert result[("C",)]["tendencia"] == "SIN CAMBIO"


def test_yearly_evolution_compares_with_the_previous_existing_year(spark):
    result = analytics.yearly_evolution(
        events(
            spark,
            ("A", 2018, "f", "Desastre", 8),
            ("A", 2021, "f", "Desastre", 9),
            ("A", 2022, "f", "Emergencia", 1),
        )
    ).collect()
    assert [(row["tipo_evento"], row["anio"], row["periodo"]) for row in result] == [
        ("Desastre", 2018, "Pre-pandemia"),
        ("Desastre", 2021, "Pandemia"),
        ("Emergencia", 2022, "Post-pandemia"),
    ]
    first, second, other = result
    for row in (first, other):
        assert row["eventos_anio_anterior"] is None
        assert row["delta_eventos"] is None
        assert row["variacion_pct"] is None
    assert (second["eventos_anio_anterior"], second["delta_eventos"]) == (8, 1)
    assert second["variacion_pct"] == 12.5
    assert second["costo_millones_mxn"] == 9.0


def test_state_ranking_ties(spark):
    result = by(
        analytics.state_ranking(
            events(
                spark,
                ("A", 2020, "f", "d", 5),
                ("B", 2022, "f", "d", 5),
                ("C", 2020, "f", "d", 1),
                ("C", 2019, "f", "d", 2),
            )
        ),
        "estado",
    )
    ranks = {
        state[0]: (row["ranking_total"], row["ranking_pandemia"], row["ranking_postpandemia"])
        for state, row in result.items()
    }
    assert ranks == {"A": (1, 1, 2), "B": (1, 3, 1), "C": (3, 2, 2)}
    assert {state[0]: row["cambio_ranking"] for state, row in result.items()} == {
        "A": -1,
        "B": 2,
        "C": 0,
    }


@pytest.mark.parametrize(
    ("during", "after", "before", "percent", "growth_class"),
    [
        (0, 3, 0, None, "NUEVO POST-PANDEMIA"),
        (0, 0, 3, None, "ESTABLE"),
        (2, 3, 0, 50.0, "INCREMENTO MODERADO"),
        (1000, 1501, 0, 50.1, "INCREMENTO ALTO (>50%)"),
        (10000, 15004, 0, 50.0, "INCREMENTO MODERADO"),
        (10, 11, 0, 10.0, "INCREMENTO MODERADO"),
        (1000, 1099, 0, 9.9, "ESTABLE"),
        (2, 2, 0, 0.0, "ESTABLE"),
        (1000, 999, 0, -0.1, "REDUCCIÓN"),
        (10000, 9996, 0, 0.0, "ESTABLE"),
    ],
)
def test_growth_classes(spark, during, after, before, percent, growth_class):
    consolidated = spark.createDataFrame(
        [("A", year, "f", n) for year, n in [(2019, before), (2020, during), (2023, after)]],
        "estado string, anio int, tipo_fenomeno string, cantidad_eventos int",
    )
    row = analytics.postperiod_growth(consolidated).collect()[0]
    assert (row["incremento_pct"], row["clasificacion"]) == (percent, growth_class)


def test_growth_leaves_out_rare_groups(spark):
    few = events(spark, ("A", 2020, "f", "d", 2), ("B", 2020, "f", "d", 3))
    result = analytics.postperiod_growth(few).collect()
    assert [row["estado"] for row in result] == ["B"]


def test_pareto_crossing_state_is_outside_the_top(spark):
    exact = analytics.pareto(
        events(spark, *[(state, 2020, "f", "d", n) for state, n in [("A", 50), ("B", 30), ("C", 20)]])
    ).collect()
    assert [(row["pct_acumulado"], row["grupo_pareto"]) for row in exact] == [
        (50.0, "TOP 80% de eventos"),
        (80.0, "TOP 80% de eventos"),
        (100.0, "Resto"),
    ]
    above = analytics.pareto(
        events(spark, *[(state, 2020, "f", "d", n) for state, n in [("A", 500), ("B", 301), ("C", 199)]])
    ).collect()
    assert [row["grupo_pareto"] for row in above] == ["TOP 80% de eventos", "Resto", "Resto"]


def test_pareto_orders_ties_by_name(spark):
    tied = events(spark, ("B", 2020, "f", "d", 2), ("A", 2020, "f", "d", 2))
    assert [row["estado"] for row in analytics.pareto(tied).collect()] == ["A", "B"]


def test_empty_input_gives_empty_results(spark):
    nothing = events(spark, ("A", 2020, "f", "d", 1)).where("false")
    for analytic in dashboard.VIEWS.values():
        assert analytic(nothing).collect() == []
    assert analytics.fact_totals(nothing).collect()[0]["registros_fact"] == 0


def test_missing_measures_count_as_zero_in_totals(spark):
    rows = spark.createDataFrame(
        [
            ("A", 2020, "f", "d", None, None, None, None, 1),
            ("A", 2020, "f", "d", 1, Decimal("2.50"), None, Decimal("0.10"), 1),
        ],
        SCHEMA,
    )
    total = analytics.fact_totals(rows).collect()[0]
    assert total["municipios_afectados"] == 1
    assert total["poblacion_afectada"] == 3
    assert total["costo_total"] == Decimal("0.10")
    assert analytics.top_state_years(rows).collect()[0]["total_eventos"] == 2


def test_consolidated_events_give_the_same_analytics(spark):
    detail = events(
        spark,
        ("A", 2019, "f", "d", 3),
        ("A", 2020, "g", "e", 4),
        ("B", 2021, "f", "d", 2),
        ("B", 2023, "f", "e", 7),
    )
    keys = ["estado", "anio", "tipo_fenomeno", "tipo_evento"]
    consolidated = grain.consolidate(detail, keys)
    assert consolidated.count() == 4
    for analytic in dashboard.VIEWS.values():
        assert analytic(consolidated).collect() == analytic(detail).collect()


def test_period_pivot_has_all_periods(spark):
    rows = analytics.period_pivot(events(spark, ("A", 2022, "f", "d", 2))).collect()
    assert [tuple(row) for row in rows] == [("A", 0, 0, 2)]


def test_periods_are_parameters(spark):
    shifted = Periods(first=2010, last=2012)
    row = analytics.period_comparison(
        events(spark, ("A", 2011, "f", "d", 1), ("A", 2013, "f", "d", 2)), shifted
    ).collect()[0]
    assert (row["eventos_pandemia"], row["eventos_postpandemia"]) == (1, 2)


def test_views_are_published(spark):
    dashboard.publish_views(events(spark, ("A", 2020, "f", "d", 3)))
    for view in dashboard.VIEWS:
        assert spark.table(view).count() == 1


def test_latest_per_key_breaks_ties(spark):
    rows = spark.createDataFrame(
        [("A", 1, 1), ("A", 2, 5), ("A", 2, 9), ("B", 3, 1)], "k string, d int, id int"
    )
    latest = grain.latest_per_key(rows, ["k"], [F.desc("d"), F.desc("id")])
    assert sorted(map(tuple, latest.collect())) == [("A", 2, 9), ("B", 3, 1)]
