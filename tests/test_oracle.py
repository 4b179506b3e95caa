"""Every query against its SQL, on the broadcast path and on the shuffled one."""

import os

import pytest
from compare import connect, differences

from indexloom.catalog import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries.registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], SF_DIR) == []


@pytest.mark.parametrize("name", ["status_audit", "price_gap_fill", "split_report", "conflicting_duplicates", "category_unmatched"])
def test_query_without_broadcast(without_broadcast, con, name):
    assert differences(without_broadcast, con, QUERIES[name], SQL[name], SF_DIR) == []
