"""The flat event view over the test tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmart.periods import Periods, YearRange
from hazardmart.schemas import AMOUNT

# The test orders span 1995 to 2001.
PERIODS = Periods(first=1998, last=1999)
YEARS = YearRange(first=1996, last=2001)

# Declared, so that building a query does not start a job to infer them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def in_years(date: Column, years: YearRange) -> Column:
    """Year range as date bounds, which unlike ``year(date)`` reach the Parquet scan."""
    start = F.lit(f"{years.first}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{years.last + 1}-01-01").cast("timestamp_ntz")
    return (date >= start) & (date < end)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the state and phenomenon they stand for."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        "n_nationkey",
        F.col("n_name").alias("estado"),
        F.col("c_mktsegment").alias("tipo_fenomeno"),
    )


def customers_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that placed an order; orders shrink to distinct customers before the join."""
    active = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    return customers(spark, sf_dir).join(active, F.col("c_custkey") == F.col("o_custkey"))


def orders_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the names of their customer and without line item measures."""
    return _named(_orders(spark, sf_dir), customers(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with all names and measures."""
    return _named(measures(spark, sf_dir), customers(spark, sf_dir))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with all measures; enough for queries without state and phenomenon.

    Line items are reduced to one row per order before the join. The left join on that unique
    key disappears from the plan of every query that needs none of its columns.
    """
    quantity = _hundredths("l_quantity")
    filled = F.col("l_linestatus") == "F"
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("int").alias("_lines"),
            F.sum(quantity).alias("_quantity"),
            F.sum(F.when(filled, quantity)).alias("_filled"),
        )
    )
    return (
        _orders(spark, sf_dir)
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            "o_orderkey",
            "o_custkey",
            "o_orderdate",
            "anio",
            "tipo_evento",
            F.coalesce("_lines", F.lit(0)).alias("municipios_afectados"),
            _amount(F.coalesce("_quantity", F.lit(0))).alias("poblacion_afectada"),
            _amount(F.coalesce("_filled", F.lit(0))).alias("poblacion_atendida"),
            "costo_total",
            "cantidad_eventos",
        )
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.year("o_orderdate").alias("anio"),
        F.col("o_orderstatus").alias("tipo_evento"),
        _amount(_hundredths("o_totalprice")).alias("costo_total"),
        F.lit(1).alias("cantidad_eventos"),
    )


def _named(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders joined to their customers.

    Customers grow with the data, so no hint asks to broadcast them: beyond the size limit this
    is a sort-merge join whose hot customers adaptive execution splits.
    """
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop(
        "o_custkey", "c_custkey"
    )


def _hundredths(measure: str) -> Column:
    """A double with at most two decimals as a whole number, which is exact and cheap to add."""
    return F.rint(F.col(measure) * 100).cast("bigint")


def _amount(hundredths: Column) -> Column:
    return (hundredths * Decimal("0.01")).cast(AMOUNT)
