"""Quality checks and reports. Every check is a small metrics frame, computed in one pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmart.schemas import AMOUNT_SUM, TEXT_LENGTHS

ANY = "cualquiera"


class DataQualityError(RuntimeError):
    """A load broke a rule that must hold before it is published."""


def counts_per_check(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``(check, n)``: rows that violate each check, all counted in one aggregation."""
    counted = rows.agg(*[F.count_if(rule).alias(name) for name, rule in checks.items()])
    return counted.unpivot([], list(checks), "check", "n")


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL per column, and rows with any."""
    rules = {name: F.col(name).isNull() for name in columns}
    return counts_per_check(rows, {**rules, ANY: reduce(or_, rules.values())})


def negative_counts(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows with a negative value per measure, and rows with any."""
    rules = {name: F.coalesce(F.col(name) < 0, F.lit(False)) for name in measures}
    return counts_per_check(rows, {**rules, ANY: reduce(or_, rules.values())})


def overlong_counts(rows: DataFrame, lengths: Mapping[str, int] = TEXT_LENGTHS) -> DataFrame:
    """Rows whose text exceeds the declared length."""
    return counts_per_check(
        rows, {name: F.length(name) > limit for name, limit in lengths.items()}
    )


def orphan_count(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, check: str
) -> DataFrame:
    """``(check, n)``: child rows whose non-null key has no parent.

    Child rows are counted per key before the join, so a frequent key is a single row there.
    """
    per_key = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_rows"))
    parents = parent.select(F.col(parent_key).alias("_parent"))
    orphans = per_key.where(F.col("_key").isNotNull()).join(
        parents, F.col("_key") == F.col("_parent"), "left_anti"
    )
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).select(
        F.lit(check).alias("check"), "n"
    )


def fact_checks(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], measures: Sequence[str]
) -> DataFrame:
    """``(check, n)``: fact rows with a NULL key, an orphan key or a negative measure.

    ``dimensions`` maps each key column to the dimension that must hold it. The fact is read
    once and reduced to its key combinations; only those meet the dimensions.
    """
    negative = reduce(or_, [F.coalesce(F.col(name) < 0, F.lit(False)) for name in measures])
    reduced = fact.groupBy(*dimensions).agg(
        F.count("*").alias("_rows"), F.count_if(negative).alias("_negative")
    )
    checks = {"negative measures": F.col("_negative")}
    for key, dimension in dimensions.items():
        found = f"_{key}"
        members = dimension.select(F.col(key).alias(found)).distinct()
        reduced = reduced.join(members, F.col(key) == F.col(found), "left")
        missing = F.col(key).isNull()
        orphan = F.col(key).isNotNull() & F.col(found).isNull()
        checks[f"null {key}"] = F.when(missing, F.col("_rows"))
        checks[f"orphan {key}"] = F.when(orphan, F.col("_rows"))
    totals = reduced.agg(
        *[F.coalesce(F.sum(rows), F.lit(0)).alias(check) for check, rows in checks.items()]
    )
    return totals.unpivot([], list(checks), "check", "n")


def duplicate_count(rows: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    """``(check, n)``: key values that occur more than once."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    return repeated.agg(F.count("*").alias("n")).select(F.lit(check).alias("check"), "n")


def row_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """``(source, n)`` per table."""
    return stack(
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        for name, rows in sources.items()
    )


def tagged_row_counts(rows: DataFrame, tag: str, sources: Mapping[str, str]) -> DataFrame:
    """``(source, n)`` for sources that one table holds, in one pass; ``sources`` maps names to tags."""
    counts = [F.count_if(F.col(tag) == value).alias(name) for name, value in sources.items()]
    return rows.agg(*counts).unpivot([], list(sources), "source", "n")


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """All frames on top of each other, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def quality_metrics(read: DataFrame, events: DataFrame) -> DataFrame:
    """``(metric, value, texto)``: rows read, fact rows, distinct members and measure totals.

    ``read`` holds the ``(source, n)`` of the rows read. Events are first reduced to their member combinations; the distinct counts then expand
    those few rows instead of every event. Consolidated events state in ``registros`` how many fact rows
    each stands for.
    """
    records = F.sum("registros") if "registros" in events.columns else F.count("*")
    distinct = {"estados": "estado", "fenomenos": "fenomeno", "tipos_evento": "tipo_evento"}
    sums = ["municipios_afectados", "poblacion_afectada", "poblacion_atendida", "costo_total"]
    per_member = events.groupBy(*distinct.values()).agg(
        records.alias("registros_fact"), *[F.sum(name).alias(name) for name in sums]
    )
    figures = per_member.agg(
        F.sum("registros_fact").cast(AMOUNT_SUM).alias("registros_fact"),
        *[F.countDistinct(name).cast(AMOUNT_SUM).alias(as_) for as_, name in distinct.items()],
        *[F.sum(name).cast(AMOUNT_SUM).alias(name) for name in sums],
    )
    sizes = read.select(
        F.concat(F.lit("leidos_"), "source").alias("metric"),
        F.col("n").cast(AMOUNT_SUM).alias("value"),
    )
    metrics = sizes.unionByName(figures.unpivot([], figures.columns, "metric", "value"))
    money, number = F.concat(F.lit("$"), F.format_number("value", 2)), F.format_number("value", 0)
    return metrics.withColumn(
        "texto", F.when(F.col("metric") == "costo_total", money).otherwise(number)
    )


def distinct_sketches(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with a mergeable sketch of the distinct non-null values of each column.

    A sketch has a few kilobytes whatever the data, so those of all loads can be kept and united. Its
    estimate is exact for few values and off by about 1.6 % (one standard deviation) for many.
    """
    return rows.agg(*[F.hll_sketch_agg(F.col(name).cast("string"), 12).alias(name) for name in columns])


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``(columna, distintos)`` over the union of all rows of sketches, from one load or several."""
    columns = sketches.columns
    united = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in columns])
    return united.unpivot([], columns, "columna", "distintos")


def integrity_nulls(events: DataFrame) -> DataFrame:
    """``(metric, value)``: NULLs per dimension column of the event table."""
    columns = ["estado", "anio", "fenomeno", "tipo_evento"]
    return (
        null_counts(events, columns)
        .where(F.col("check") != ANY)
        .select(F.col("check").alias("metric"), F.col("n").alias("value"))
    )


def missing_tables(
    spark: SparkSession, expected: Iterable[str], database: str | None = None
) -> list[str]:
    """Expected tables or views the catalog does not list, sorted by name."""
    listed = {table.name for table in spark.catalog.listTables(database)}
    return sorted(set(expected) - listed)


def require_zero(checks: DataFrame) -> None:
    """Raise when any ``(check, n)`` row counts a violation."""
    broken = [f"{row['check']}: {row['n']}" for row in checks.where("n > 0").collect()]
    if broken:
        raise DataQualityError("; ".join(broken))
