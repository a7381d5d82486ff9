"""Every registered query against its expected result."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hazardmart.trial.queries import QUERIES
from tests.compare import connect, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert queries().keys() >= oracle_sql().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    columns, rows = spark_rows(queries()[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(duck, oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry(spark):
    assert entry(spark).columns[0] == "estado"
