"""Sales whose supplier, part or order no table lists stay, as Missing."""

import shutil

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from compare import TABLES, connect, differences

from indexloom.catalog import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries.registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def orphaned(tmp_path_factory):
    folder = tmp_path_factory.mktemp("orphaned")
    for name in TABLES:
        shutil.copyfile(f"{SF_DIR}/{name}.parquet", folder / f"{name}.parquet")
    table = pq.read_table(f"{SF_DIR}/lineitem.parquet")
    order = pc.cast(table["l_orderkey"], pa.int64())
    for column, value, chosen in (("l_suppkey", 10**9, 3), ("l_suppkey", None, 5), ("l_partkey", 10**9, 7), ("l_partkey", None, 11)):
        hit = pc.equal(pc.subtract(order, pc.multiply(pc.divide(order, chosen), chosen)), 0)
        place = table.schema.get_field_index(column)
        table = table.set_column(place, column, pc.if_else(hit, pa.scalar(value, table.schema.field(column).type), table[column]))
    (folder / "lineitem.parquet").unlink()
    pq.write_table(table, folder / "lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["control_totals", "map_sector", "missing_lookup", "missing_sector_rows", "status_audit", "left_lookup_4key", "category_lookup",
     "category_unmatched", "not_in_filter", "split_by_category", "cell_grid", "cell_grid_rows", "split_report", "usage_rollup",
     "derived_price_join_wide", "price_gap_fill"],
)
def test_query(spark, orphaned, name):
    assert differences(spark, connect(orphaned), QUERIES[name], SQL[name], orphaned) == []
