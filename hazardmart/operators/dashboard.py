"""Data sets behind the dashboard tiles, and the views they are published as."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmart.functions.measures import total, whole
from hazardmart.operators import analytics
from hazardmart.periods import PERIODS, Periods

# Names of the published views.
VIEWS = {
    "vw_pandemia_vs_postpandemia": analytics.period_comparison,
    "vw_evolucion_anual_eventos": analytics.yearly_evolution,
    "vw_ranking_estados_eventos": analytics.state_ranking,
    "vw_incremento_postpandemia_fenomenos": analytics.postperiod_growth,
    "vw_eventos_estados": analytics.pareto,
}


def kpi_cards(events: DataFrame) -> DataFrame:
    """Totals and the number of states with data."""
    return events.agg(
        total("cantidad_eventos").alias("total_eventos"),
        whole(F.sum("poblacion_afectada")).alias("poblacion_afectada"),
        total("municipios_afectados").alias("municipios_afectados"),
        F.countDistinct("estado").alias("estados_con_datos"),
    )


def top_states_by_growth(
    events: DataFrame, periods: Periods = PERIODS, limit: int = 5
) -> DataFrame:
    """States whose event count grew most after the reference period."""
    return (
        analytics.period_comparison(events, periods)
        .groupBy("estado")
        .agg(
            F.sum("eventos_pandemia").alias("eventos_pandemia"),
            F.sum("eventos_postpandemia").alias("eventos_postpandemia"),
            F.sum("diferencia_absoluta").alias("diferencia"),
        )
        .orderBy(F.desc("diferencia"), "estado")
        .limit(limit)
    )


def yearly_series(events: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Time series of events, one line per declaration type."""
    return analytics.yearly_evolution(events, periods).select(
        "anio", "tipo_evento", "total_eventos"
    )


def top_states_total(events: DataFrame, periods: Periods = PERIODS, limit: int = 5) -> DataFrame:
    """States with the most events over all years."""
    return (
        analytics.state_ranking(events, periods)
        .orderBy("ranking_total", "estado")
        .limit(limit)
        .select("ranking_total", "estado", "total_eventos")
    )


def growth_by_phenomenon(events: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Growth per phenomenon and state."""
    return (
        analytics.postperiod_growth(events, periods)
        .select("tipo_fenomeno", "estado", "incremento_absoluto", "incremento_pct")
        .orderBy("tipo_fenomeno", F.desc_nulls_last("incremento_absoluto"), "estado")
    )


def pareto_state_count(events: DataFrame, top_percent: int = 80) -> DataFrame:
    """Number of states that together stay within the top share of events."""
    return (
        analytics.pareto(events, top_percent)
        .where(F.col("grupo_pareto") != "Resto")
        .agg(F.count("*").alias(f"estados_top{top_percent}"))
    )


# Names of the further results that every load stores.
RESULTS = {
    "res_top_estado_anio": lambda events, periods: analytics.top_state_years(events),
    "res_totales_fact": lambda events, periods: analytics.fact_totals(events),
    "res_cubo_top20": lambda events, periods: analytics.star_cube(events),
    "res_kpi": lambda events, periods: kpi_cards(events),
    "res_top5_crecimiento": top_states_by_growth,
    "res_serie_anual": yearly_series,
    "res_top5_total": top_states_total,
    "res_crecimiento_fenomeno": growth_by_phenomenon,
    "res_estados_pareto": lambda events, periods: pareto_state_count(events),
    "res_periodos_estado": analytics.period_pivot,
}


def results(events: DataFrame, periods: Periods = PERIODS) -> dict[str, DataFrame]:
    """Top lists, totals, cards and series over one flat event view, by table name."""
    return {name: result(events, periods) for name, result in RESULTS.items()}


def views(events: DataFrame, periods: Periods = PERIODS) -> dict[str, DataFrame]:
    """The five published analytics over one flat event view, by view name."""
    return {
        name: analytic(events) if analytic is analytics.pareto else analytic(events, periods)
        for name, analytic in VIEWS.items()
    }


def publish_views(events: DataFrame, periods: Periods = PERIODS) -> None:
    """Register the five analytics as session views that follow ``events``."""
    for name, result in views(events, periods).items():
        result.createOrReplaceTempView(name)
