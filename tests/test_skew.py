"""One key holds a third of the rows, as copies of one row, and the inputs are too large to broadcast."""

import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import TABLES, connect, differences

from indexloom.catalog import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries.registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        shutil.copyfile(f"{SF_DIR}/{name}.parquet", folder / f"{name}.parquet")
    for name, third in (("lineitem", 3000), ("orders", 750)):
        table = pq.read_table(f"{SF_DIR}/{name}.parquet")
        copies = pa.concat_tables([table.slice(11, 1)] * third)
        (folder / f"{name}.parquet").unlink()
        pq.write_table(pa.concat_tables([table, copies]), folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["control_totals", "status_audit", "left_lookup_4key", "advance_rollup", "latest_validity", "dedupe_keep_first",
     "conflicting_duplicates", "flow_fare_join", "price_gap_fill", "big_earners", "split_report", "lookup_only_new",
     "list_price_join_wide", "derived_price_join_wide"],
)
def test_query(without_broadcast, skewed, name):
    assert differences(without_broadcast, connect(skewed), QUERIES[name], SQL[name], skewed) == []
