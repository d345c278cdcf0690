"""Every registered query against its SQL, on the smallest test tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as spark_entry
from compare import compare, database
from tagtable.workload import scale  # noqa: F401 - with the entry module
from tagtable.workload.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def db():
    return database(SMALL)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(SQL) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, SMALL, name) is None


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["CUST_ID", "TAG_CODE", "TAG_VALUE", "TAG_VALUE_NAME", "DATA_DATE"]
    assert result.count() > 0
