"""The published analytics.

Every function takes the flat event view (one row per event, or any consolidation of it):
``estado, anio, tipo_fenomeno, tipo_evento`` plus the measures. Each first reduces it with one
hash aggregation whose map-side half absorbs frequent keys; windows only ever see the reduced
rows. Windows without a partition run over states, whose number the catalogue bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardmart.functions.measures import (
    count_where,
    exact_sum,
    millions,
    percent,
    total,
    total_where,
    whole,
)
from hazardmart.periods import PERIODS, Periods


def period_comparison(events: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Events during and after the reference period per state, type and phenomenon."""
    year = F.col("anio")
    during, after = F.col("eventos_pandemia"), F.col("eventos_postpandemia")
    trend = (
        F.when(after > during, "AUMENTO")
        .when(after < during, "DISMINUCIÓN")
        .otherwise("SIN CAMBIO")
    )
    return (
        events.groupBy("estado", "tipo_evento", "tipo_fenomeno")
        .agg(
            count_where(periods.during(year), "cantidad_eventos").alias("eventos_pandemia"),
            count_where(periods.after(year), "cantidad_eventos").alias("eventos_postpandemia"),
            total("cantidad_eventos").alias("total_historico"),
            count_where(periods.after(year), "municipios_afectados").alias(
                "municipios_postpandemia"
            ),
            whole(total_where(periods.after(year), "poblacion_afectada")).alias(
                "poblacion_postpandemia"
            ),
        )
        .where(F.col("total_historico") > 0)
        .withColumn("diferencia_absoluta", after - during)
        .withColumn("tendencia", trend)
        .orderBy(F.desc("diferencia_absoluta"), "estado", "tipo_evento", "tipo_fenomeno")
    )


def yearly_evolution(events: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Yearly totals per type with the change from the previous year that has events."""
    history = Window.partitionBy("tipo_evento").orderBy("anio")
    current, previous = F.col("total_eventos"), F.col("eventos_anio_anterior")
    change = F.round(percent(current, previous) - 100, 1).cast("double")
    return (
        events.groupBy("anio", "tipo_evento")
        .agg(
            total("cantidad_eventos").alias("total_eventos"),
            total("municipios_afectados").alias("total_municipios"),
            whole(F.sum("poblacion_afectada")).alias("total_poblacion"),
            millions(F.sum("costo_total")).alias("costo_millones_mxn"),
        )
        .withColumn("eventos_anio_anterior", F.lag("total_eventos").over(history))
        .withColumn("delta_eventos", current - previous)
        .withColumn("variacion_pct", change)
        .withColumn("periodo", periods.label(F.col("anio")))
        .orderBy("tipo_evento", "anio")
    )


def state_ranking(events: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """States ranked overall and per period; a positive rank change means a climb."""
    year = F.col("anio")
    return (
        events.groupBy("estado")
        .agg(
            total("cantidad_eventos").alias("total_eventos"),
            count_where(periods.before(year), "cantidad_eventos").alias("eventos_pre_pandemia"),
            count_where(periods.during(year), "cantidad_eventos").alias("eventos_pandemia"),
            count_where(periods.after(year), "cantidad_eventos").alias("eventos_postpandemia"),
            total("municipios_afectados").alias("total_municipios"),
            whole(F.sum("poblacion_afectada")).alias("total_poblacion"),
            millions(F.sum("costo_total")).alias("costo_millones_mxn"),
        )
        .select(
            _standing(F.rank(), "total_eventos").alias("ranking_total"),
            _standing(F.dense_rank(), "eventos_postpandemia").alias("ranking_postpandemia"),
            _standing(F.dense_rank(), "eventos_pandemia").alias("ranking_pandemia"),
            "*",
        )
        .withColumn("cambio_ranking", F.col("ranking_pandemia") - F.col("ranking_postpandemia"))
        .orderBy("ranking_total", "estado")
    )


def postperiod_growth(
    events: DataFrame, periods: Periods = PERIODS, min_events: int = 3
) -> DataFrame:
    """Growth class of every state and phenomenon with at least ``min_events`` events.

    The class follows the rounded percentage, so 50.04 % still counts as moderate.
    """
    year = F.col("anio")
    during, after = F.col("eventos_pandemia"), F.col("eventos_postpandemia")
    growth = F.col("incremento_pct")
    growth_class = (
        F.when((during == 0) & (after > 0), "NUEVO POST-PANDEMIA")
        .when(growth > 50, "INCREMENTO ALTO (>50%)")
        .when(growth.between(10, 50), "INCREMENTO MODERADO")
        .when(growth < 0, "REDUCCIÓN")
        .otherwise("ESTABLE")
    )
    return (
        events.groupBy("estado", "tipo_fenomeno")
        .agg(
            count_where(periods.during(year), "cantidad_eventos").alias("eventos_pandemia"),
            count_where(periods.after(year), "cantidad_eventos").alias("eventos_postpandemia"),
            total("cantidad_eventos").alias("total_eventos"),
        )
        .where(F.col("total_eventos") >= min_events)
        .withColumn("incremento_absoluto", after - during)
        .withColumn("incremento_pct", F.round(percent(after - during, during), 1).cast("double"))
        .withColumn("clasificacion", growth_class)
        .orderBy(
            F.desc_nulls_last("incremento_absoluto"),
            F.desc_nulls_last("incremento_pct"),
            "estado",
            "tipo_fenomeno",
        )
    )


def pareto(events: DataFrame, top_percent: int = 80) -> DataFrame:
    """Cumulative share of events per state, largest first; ties are ordered by name.

    The national total is a window sum over the same state rows, so no join is needed.
    """
    nation = Window.partitionBy()
    largest_first = Window.orderBy(F.desc("total_eventos"), "estado")
    so_far = largest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.round(percent(F.col("total_eventos"), F.col("_nation")), 2).cast("double")
    running = F.round(percent(F.col("eventos_acumulados"), F.col("_nation")), 1).cast("double")
    return (
        events.groupBy("estado")
        .agg(
            total("cantidad_eventos").alias("total_eventos"),
            whole(F.sum("poblacion_afectada")).alias("poblacion_afectada"),
        )
        .withColumn("_nation", F.sum("total_eventos").over(nation))
        .withColumn("pct_nacional", share)
        .withColumn("eventos_acumulados", F.sum("total_eventos").over(so_far))
        .withColumn("pct_acumulado", running)
        .withColumn(
            "grupo_pareto",
            F.when(F.col("pct_acumulado") <= top_percent, f"TOP {top_percent}% de eventos")
            .otherwise("Resto"),
        )
        .drop("_nation")
        .orderBy(F.desc("total_eventos"), "estado")
    )


def top_state_years(events: DataFrame, limit: int = 10) -> DataFrame:
    """State-years with the most events."""
    return (
        events.groupBy("estado", "anio")
        .agg(
            total("cantidad_eventos").alias("total_eventos"),
            F.sum(F.coalesce("municipios_afectados", F.lit(0)))
            .cast("bigint")
            .alias("municipios_afectados"),
            exact_sum("poblacion_afectada").alias("poblacion_afectada"),
            exact_sum("costo_total").alias("costo_total"),
        )
        .orderBy(F.desc("total_eventos"), "estado", "anio")
        .limit(limit)
    )


def star_cube(events: DataFrame, limit: int = 20) -> DataFrame:
    """Key combinations of all four dimensions with the most events."""
    keys = ["estado", "anio", "tipo_fenomeno", "tipo_evento"]
    return (
        events.groupBy(*keys)
        .agg(total("cantidad_eventos").alias("total_eventos"))
        .orderBy(F.desc("total_eventos"), *keys)
        .limit(limit)
    )


def fact_totals(events: DataFrame) -> DataFrame:
    """One row of grand totals; consolidated events state in ``registros`` how many fact rows they are."""
    records = F.sum("registros") if "registros" in events.columns else F.count("*")
    return events.agg(
        records.alias("registros_fact"),
        total("cantidad_eventos").alias("total_eventos"),
        F.sum(F.coalesce("municipios_afectados", F.lit(0)))
        .cast("bigint")
        .alias("municipios_afectados"),
        whole(exact_sum("poblacion_afectada")).alias("poblacion_afectada"),
        exact_sum("costo_total").alias("costo_total"),
    )


def period_pivot(events: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Events per state, one column per period."""
    columns = {
        periods.before_label: "pre",
        periods.during_label: "pandemia",
        periods.after_label: "post",
    }
    counted = (
        events.groupBy("estado", periods.label(F.col("anio")).alias("_period"))
        .agg(total("cantidad_eventos").alias("_events"))
        .groupBy("estado")
        .pivot("_period", list(columns))
        .agg(F.sum("_events"))
    )
    return counted.select(
        "estado",
        *[F.coalesce(F.col(f"`{label}`"), F.lit(0)).alias(name) for label, name in columns.items()],
    )


def _standing(rank: Column, measure: str) -> Column:
    return rank.over(Window.orderBy(F.desc(measure))).cast("bigint")
