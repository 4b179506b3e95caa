"""Results whose order is part of them: row by row against SQL that orders the same way."""

import os

import pytest
from compare import connect

from indexloom.catalog import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries.registered(), oracle.oracle_sql()
ORDERED = {
    "big_change": ["weight DESC NULLS LAST"], "little_change": ["weight DESC NULLS LAST"], "big_earners": ["weight DESC NULLS LAST"],
    "series_extend": ["category_order", "label_order"], "series_extend_ticket_type": ["category_order", "label_order"],
    "usage_rollup": ["financial_year_key", "year_and_quarter"],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    columns = [c.split()[0] for c in ORDERED[name]]
    found = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF_DIR).collect()]
    sql = f"SELECT {', '.join(columns)} FROM ({SQL[name]}) AS q ORDER BY {', '.join(ORDERED[name])}"
    assert found == connect(SF_DIR).execute(sql).fetchall() and len(found) > 1
