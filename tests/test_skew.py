"""One customer and one order hold a third of all rows, and no side may be broadcast."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from hazardmart.trial.tables import table
from tests.compare import connect, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "period_comparison",
    "state_ranking",
    "pareto",
    "dedup_latest",
    "dim_state",
    "fact_load",
    "dq_orphan_keys",
    "quality_metrics",
]


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    third = F.col("l_partkey") % 3 == 0
    changed = {
        "orders": table(spark, SF_DIR, "orders").withColumn(
            "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey"))
        ),
        "lineitem": table(spark, SF_DIR, "lineitem").withColumn(
            "l_orderkey", F.when(third, 5).otherwise(F.col("l_orderkey"))
        ),
    }
    for name in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        rows = changed.get(name, table(spark, SF_DIR, name))
        rows.toPandas().to_parquet(folder / f"{name}.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.fixture()
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_do_not_change_results(spark, hot_tables, no_broadcast, name):
    expected = oracle_rows(connect(hot_tables), oracle_sql()[name])
    assert spark_rows(queries()[name](spark, hot_tables)) == expected
