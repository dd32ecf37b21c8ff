"""Every query against its SQL counterpart on the smallest data folder."""

import os

import pytest

import check_queries
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees_with_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF_DIR, name) == []


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry_is_the_indicator_table(spark):
    table = entry(spark)
    assert table.columns[:4] == ["point_id", "latitude", "longitude", "country"]
    assert table.count() == 10
