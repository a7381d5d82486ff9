"""One Spark query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmart.functions import cleansing
from hazardmart.operators import analytics, conform, dashboard, grain, keys, quality
from hazardmart.operators.row_ids import with_row_ids
from hazardmart.plans import cleanse, star
from hazardmart.plans.events import in_year_range, with_verdict
from hazardmart.schemas import AMOUNT, EVENT_ID, FACT_KEYS, MEASURES
from hazardmart.sources.landed import land
from hazardmart.trial import staging
from hazardmart.trial.tables import (
    PERIODS,
    YEARS,
    customers_with_orders,
    events,
    in_years,
    measures,
    orders_with_names,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Order status that stands for each source, and the description of its rows.
SOURCE_TAGS = {"desastres": "F", "emergencias": "O", "proyectos": "P"}
SPECS = {"F": cleanse.DISASTERS, "O": cleanse.EMERGENCIES, "P": cleanse.PREVENTION}


def period_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.period_comparison(events(spark, sf_dir), PERIODS)


def yearly_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.yearly_evolution(measures(spark, sf_dir), PERIODS)


def state_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.state_ranking(events(spark, sf_dir), PERIODS)


def postperiod_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.postperiod_growth(events(spark, sf_dir), PERIODS)


def pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.pareto(events(spark, sf_dir))


def pareto_state_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.pareto_state_count(events(spark, sf_dir))


def top10_state_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_state_years(events(spark, sf_dir))


def star_cube_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the star: fact rows keyed by the dimensions and joined back to them.

    Not landed: neither the members nor the counted fact needs line items, so both plans drop
    the one large scan that a landed table would have to include.
    """
    flat = events(spark, sf_dir).withColumnRenamed("tipo_fenomeno", "fenomeno")
    dimensions = star.build_dimensions(flat, ["F", "O", "P"])
    return analytics.star_cube(star.flat_events(star.load_fact(flat, dimensions), dimensions))


def fact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.fact_totals(measures(spark, sf_dir))


def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.kpi_cards(events(spark, sf_dir))


def top5_states_by_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_states_by_growth(events(spark, sf_dir), PERIODS)


def top5_states_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_states_total(events(spark, sf_dir), PERIODS)


def yearly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.yearly_series(measures(spark, sf_dir), PERIODS)


def growth_by_phenomenon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.growth_by_phenomenon(events(spark, sf_dir), PERIODS)


def period_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.period_pivot(events(spark, sf_dir), PERIODS)


def dim_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_state(customers_with_orders(spark, sf_dir))


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(in_years(F.col("o_orderdate"), YEARS))
    return star.dim_time(orders.select(F.year("o_orderdate").alias("anio")))


def dim_phenomenon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market segments of customers with orders."""
    named = customers_with_orders(spark, sf_dir).withColumnRenamed("tipo_fenomeno", "fenomeno")
    return star.dim_phenomenon(named)


def dim_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types with the number of orders of each."""
    per_type = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderstatus").alias("tipo_evento"))
        .agg(F.count("*").alias("eventos"))
    )
    return star.dim_event_type(spark, ["F", "O", "P"]).join(per_type, "tipo_evento")


def dim_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of three regions are known; all states with customers are offered."""
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_name", "estado")
    existing = keys.number_bounded(
        nation.where(F.col("n_regionkey") <= 2).select("estado"), "estado", "id_estado"
    )
    customer = table(spark, sf_dir, "customer")
    offered = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return keys.insert_if_absent(existing, offered, "estado", "id_estado")


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    spellings = [
        "<lower>",
        "   <priority> ",
        "\t\n<priority>\r\n",
        "\u00a0\u2003<lower>\u3000\x1c",
        None,
        "michoacán ñ <priority>",
        "a  b <priority>",
    ]
    raw = staging.spell(spellings, priority=priority, lower=F.lower(priority))
    return _cleaned(spark, sf_dir, cleansing.clean_text(raw), "texto")


def clean_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.number_text(F.col("o_totalprice").cast(AMOUNT))
    return _cleaned(spark, sf_dir, cleansing.clean_number(raw), "numero")


def clean_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.money_text(F.col("o_totalprice").cast(AMOUNT))
    return _cleaned(spark, sf_dir, cleansing.clean_money(raw), "monto")


def coerce_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.year_text(F.year("o_orderdate"))
    return _cleaned(spark, sf_dir, cleansing.coerce_year(raw), "anio")


def coerce_default_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.count_text(F.col("o_custkey"))
    return _cleaned(spark, sf_dir, cleansing.coerce_count(raw), "cantidad")


def conform_dimension_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformed_states(spark, sf_dir)


def conform_with_null_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = orders_with_names(spark, sf_dir).select(
        "o_orderkey", staging.phenomenon_text(F.col("tipo_fenomeno")).alias("raw")
    )
    phenomena = staging.catalogues(spark, sf_dir).phenomena
    return conform.conform_phenomenon(named, "raw", "fenomeno", phenomena).drop("raw")


def conform_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    raw = staging.spell(
        ["<status>", "<lower>", "\t<status> ", None], status=status, lower=F.lower(status)
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    types = staging.catalogues(spark, sf_dir).event_types
    return conform.conform_event_type(orders, "raw", "tipo_evento", types).drop("raw")


def valid_value_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = staging.catalogues(spark, sf_dir).states
    return conform.keep_valid(_conformed_states(spark, sf_dir), "estado", states)


def rejected_values_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = staging.catalogues(spark, sf_dir).states
    return conform.rejected_values(_conformed_states(spark, sf_dir), "estado", states)


def clean_disasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.disasters(spark, sf_dir)
    return cleanse.clean_disasters(raw, staging.catalogues(spark, sf_dir), ["o_orderkey"])


def clean_emergencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.emergencies(spark, sf_dir)
    return cleanse.clean_emergencies(raw, staging.catalogues(spark, sf_dir), ["o_orderkey"])


def clean_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = staging.projects(spark, sf_dir)
    return cleanse.clean_projects(raw, staging.catalogues(spark, sf_dir)).select(
        "o_orderkey", "estado", "anio_autorizacion", "personas_beneficiadas", "costo_total"
    )


def fact_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_year_range(_judged(spark, sf_dir, "F", "O"))


def fact_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected rows per reason and declaration type."""
    judged = _judged(spark, sf_dir, "F", "O")
    return judged.groupBy("tipo_evento", "verdict").agg(F.count("*").alias("n"))


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ids that follow from the order key; see ``fact_row_ids`` for rows without a key."""
    base = with_row_ids(_landed_base(spark, sf_dir), EVENT_ID, unique_key=["o_orderkey"])
    return star.load_fact(base, star.build_dimensions(base), keep=[EVENT_ID, "o_orderkey"])


def fact_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations without any key: equal ones get different ids."""
    declared = events(spark, sf_dir).select("estado", "anio", "tipo_fenomeno", "tipo_evento", "municipios_afectados")
    return with_row_ids(declared, EVENT_ID)


def parse_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that became no number; some disasters count more municipalities than an ``int`` holds."""
    known = staging.catalogues(spark, sf_dir)
    disasters = staging.disasters(spark, sf_dir)
    large = F.when(F.col("o_orderkey") % 7 == 0, "99999999999").otherwise(F.col("numero_municipios_corroborados"))
    declared = {
        cleanse.DISASTERS: disasters.withColumn("numero_municipios_corroborados", large),
        cleanse.EMERGENCIES: staging.emergencies(spark, sf_dir),
    }
    traced = [
        cleanse.to_events(rows, spec, known, [cleanse.lost_texts(spec).alias("perdidas")])
        for spec, rows in declared.items()
    ]
    return cleanse.loss_counts(quality.stack(traced))


def fact_verdicts_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts where unlisted phenomena are refused as well."""
    known = staging.catalogues(spark, sf_dir)
    emergencies = cleanse.to_events(staging.emergencies(spark, sf_dir), cleanse.EMERGENCIES, known)
    judged = with_verdict(emergencies, known.states, YEARS, known.phenomena, known.event_types)
    return judged.groupBy("verdict").agg(F.count("*").alias("n"))


def totals_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grand totals of the declarations and of their consolidation."""
    detail = events(spark, sf_dir).withColumn("registros", F.lit(1).cast("bigint"))
    cube = grain.consolidate(detail, ["estado", "anio", "tipo_fenomeno", "tipo_evento"], more=["registros"])
    return quality.stack(
        analytics.fact_totals(rows).withColumn("grano", F.lit(name))
        for name, rows in {"detalle": detail, "consolidado": cube}.items()
    )


def distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values from sketches, one per declared type, united."""
    named = orders_with_names(spark, sf_dir)
    columns = ["estado", "tipo_fenomeno", "anio"]
    parts = [named.where(F.col("tipo_evento") == status) for status in ("F", "O", "P")]
    return quality.distinct_estimates(quality.stack(quality.distinct_sketches(part, columns) for part in parts))


def fact_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grain.consolidate(
        events(spark, sf_dir), ["estado", "anio", "tipo_fenomeno", "tipo_evento"]
    )


def fact_with_prevention(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_prevention = in_year_range(_judged(spark, sf_dir, "F", "O", "P"))
    return with_prevention.groupBy("tipo_evento").agg(
        F.count("*").alias("registros"),
        F.count("fenomeno").alias("con_fenomeno"),
        F.sum("poblacion_afectada").cast("decimal(38,2)").alias("poblacion_afectada"),
        F.sum("costo_total").cast("decimal(38,2)").alias("costo_total"),
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grain.latest_per_key(
        orders_with_names(spark, sf_dir).drop("n_nationkey", "cantidad_eventos"),
        ["estado", "anio", "tipo_fenomeno"],
        [F.desc("o_orderdate"), F.desc("o_orderkey")],
    )


def source_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(_sources(spark, sf_dir))


def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(fact_load(spark, sf_dir), FACT_KEYS)


def dq_negative_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    orders = measures(spark, sf_dir)
    return quality.stack(
        [
            quality.negative_counts(customer, ["c_acctbal"]),
            quality.negative_counts(orders, list(MEASURES)).where(F.col("check") != quality.ANY),
        ]
    )


def dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nation is taken out of the parents, so its customers and suppliers are orphans."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey <> 3")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return quality.stack(
        [
            quality.orphan_count(customer, "c_nationkey", nation, "n_nationkey", "c_nationkey"),
            quality.orphan_count(supplier, "s_nationkey", nation, "n_nationkey", "s_nationkey"),
            quality.orphan_count(orders, "o_custkey", customer, "c_custkey", "o_custkey"),
            quality.orphan_count(lineitem, "l_orderkey", orders, "o_orderkey", "l_orderkey"),
        ]
    )


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, nation = table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    lineitem = table(spark, sf_dir, "lineitem")
    return quality.stack(
        [
            quality.duplicate_count(nation, ["n_nationkey"], "n_nationkey"),
            quality.duplicate_count(nation, ["n_name"], "n_name"),
            quality.duplicate_count(orders, ["o_orderkey"], "o_orderkey"),
            quality.duplicate_count(orders, ["o_custkey"], "o_custkey"),
            quality.duplicate_count(lineitem, ["l_orderkey", "l_linenumber"], "l_line"),
            quality.duplicate_count(fact_row_ids(spark, sf_dir), [EVENT_ID], EVENT_ID),
        ]
    )


def dq_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return quality.overlong_counts(part, {"p_name": 8, "p_brand": 100, "p_type": 5})


def dq_fact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fact rules in one pass; two dimensions lost a member each."""
    base = _landed_base(spark, sf_dir)
    dimensions = star.build_dimensions(base)
    fact = star.load_fact(base, dimensions)
    present = {
        "id_estado": dimensions.estado.where("id_estado <> 2"),
        "id_tiempo": dimensions.tiempo,
        "id_fenomeno": dimensions.fenomeno.where("id_fenomeno <> 1"),
        "id_tipo_evento": dimensions.tipo_evento,
    }
    return quality.fact_checks(fact, present, list(MEASURES))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = quality.tagged_row_counts(table(spark, sf_dir, "orders"), "o_orderstatus", SOURCE_TAGS)
    return quality.quality_metrics(read, fact_base(spark, sf_dir))


def integrity_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity_nulls(fact_base(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        period_comparison,
        yearly_evolution,
        state_ranking,
        postperiod_growth,
        pareto,
        pareto_state_count,
        top10_state_year,
        star_cube_top20,
        fact_totals,
        kpi_cards,
        top5_states_by_growth,
        top5_states_total,
        yearly_series,
        growth_by_phenomenon,
        period_pivot,
        dim_state,
        dim_time,
        dim_phenomenon,
        dim_event_type,
        dim_insert_if_absent,
        clean_text,
        clean_number,
        clean_money,
        coerce_year,
        coerce_default_zero,
        conform_dimension_value,
        conform_with_null_markers,
        conform_strict,
        valid_value_semi_join,
        rejected_values_anti_join,
        clean_disasters,
        clean_emergencies,
        clean_projects,
        fact_base,
        fact_verdicts,
        fact_load,
        fact_row_ids,
        parse_losses,
        fact_verdicts_strict,
        totals_by_grain,
        distinct_estimates,
        fact_grain,
        fact_with_prevention,
        dedup_latest,
        source_row_counts,
        dq_null_keys,
        dq_negative_measures,
        dq_orphan_keys,
        dq_duplicate_keys,
        dq_text_length,
        dq_fact_checks,
        quality_metrics,
        integrity_null_counts,
    )
}


def _cleaned(spark: SparkSession, sf_dir: str, value: Column, name: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", value.alias(name))


def _judged(spark: SparkSession, sf_dir: str, *statuses: str) -> DataFrame:
    """Rows of the sources with these statuses as events with verdict, from one scan of the feed."""
    known = staging.catalogues(spark, sf_dir)
    specs = {status: SPECS[status] for status in statuses}
    declared = cleanse.feed_to_events(staging.feed(spark, sf_dir), "fuente", specs, known, ["o_orderkey"])
    return with_verdict(declared, known.states, YEARS)


def _landed_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleansed events written once: dimensions and fact both read them."""
    return land(fact_base(spark, sf_dir), "events")


def _conformed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = staging.state_text(F.col("estado"), F.col("n_nationkey"))
    raw = orders_with_names(spark, sf_dir).select("o_orderkey", spelled.alias("raw"))
    states = staging.catalogues(spark, sf_dir).states
    return conform.conform_state(raw, "raw", "estado", states).drop("raw")


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return {
        name: orders.where(F.col("o_orderstatus") == status) for name, status in SOURCE_TAGS.items()
    }
