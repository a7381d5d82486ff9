"""Physical plans: what is read, what is pushed down, what is never shuffled or broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from hazardmart.catalogues import Catalogues
from hazardmart.plans import cleanse
from hazardmart.schemas import EMERGENCY_STAGING
from hazardmart.trial.tables import customers, measures, table
from tests.plans import plan_of

SF_DIR = "/root/testdata/sf0.001"
LARGER_SF_DIR = "/root/testdata/sf0.01"


def scanned(plan: str) -> set[str]:
    return set(re.findall(r"/(\w+)\.parquet", plan))


@pytest.mark.parametrize(
    ("name", "tables"),
    [
        ("period_comparison", {"orders", "customer", "nation", "lineitem"}),
        ("state_ranking", {"orders", "customer", "nation", "lineitem"}),
        ("yearly_evolution", {"orders", "lineitem"}),
        ("yearly_series", {"orders"}),
        ("postperiod_growth", {"orders", "customer", "nation"}),
        ("period_pivot", {"orders", "customer", "nation"}),
        ("dedup_latest", {"orders", "customer", "nation"}),
        ("clean_number", {"orders"}),
        ("dim_time", {"orders"}),
    ],
)
def test_only_needed_tables_are_read(spark, name, tables):
    assert scanned(plan_of(queries()[name](spark, SF_DIR))) == tables


def test_no_query_uses_a_cross_join_or_a_udf(spark):
    for name in ("pareto", "state_ranking", "fact_base", "quality_metrics", "kpi_cards"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
            assert node not in plan, (name, node)


@pytest.mark.parametrize("name", ["fact_base", "fact_with_prevention", "fact_verdicts", "quality_metrics"])
def test_all_sources_are_cleansed_in_one_scan(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR), "formatted")
    assert plan.count("/lineitem.parquet") <= 1
    assert plan.count("/orders.parquet") <= (2 if name == "quality_metrics" else 1)


def test_emergencies_read_only_the_columns_they_use(spark, tmp_path):
    path = str(tmp_path / "staging")
    spark.createDataFrame([tuple(["1"] * 84)], EMERGENCY_STAGING).write.parquet(path)
    raw = spark.read.schema(EMERGENCY_STAGING).parquet(path)
    plan = plan_of(cleanse.clean_emergencies(raw, Catalogues.official(spark)), "formatted")
    assert re.search(r"Scan parquet\s+Output \[(\d+)\]", plan).group(1) == "7"


def test_year_range_reaches_the_scan(spark):
    plan = plan_of(queries()["dim_time"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996" in plan


def test_latest_row_is_picked_before_the_shuffle(spark):
    plan = plan_of(queries()["dedup_latest"](spark, SF_DIR))
    partial = re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", plan)
    assert partial and plan.index("Exchange hashpartitioning(estado") < partial.start()


def test_totals_are_aggregated_before_the_shuffle(spark):
    plan = plan_of(queries()["fact_totals"](spark, SF_DIR))
    assert "partial_sum" in plan
    assert "Exchange SinglePartition" in plan


def test_hot_customer_is_split_over_tasks(spark, tmp_path):
    orders = measures(spark, LARGER_SF_DIR).withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey"))
    )
    path = str(tmp_path / "orders")
    orders.drop("municipios_afectados").repartition(16).write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.openCostInBytes": "64MB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        named = spark.read.parquet(path).join(
            customers(spark, LARGER_SF_DIR), F.col("o_custkey") == F.col("c_custkey")
        )
        result = named.groupBy("estado").agg(
            F.sum("cantidad_eventos").alias("n"), F.sum("costo_total"), F.max("o_orderkey")
        )
        total = sum(row["n"] for row in result.collect())
        plan = plan_of(result)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert total == table(spark, LARGER_SF_DIR, "orders").count()
    assert "skew=true" in plan
