"""Every registered query against its DuckDB SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.expected import ORACLE_SQL
from tillwork.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(queries()[name](spark, SF), duck, oracle_sql()[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "daily_sale" in df.columns
