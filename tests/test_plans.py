"""Plans have to be the ones that hold at scale."""

import re

import pytest

from indexloom.catalog import queries
from indexloom.catalog import tables as t
from indexloom.sources import tables as stored

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.registered()
# Windows are for data that is already summed: quarters, years, and the parts of a report.
WINDOWED = {
    "split_report", "split_report_rows", "split_sector", "split_class", "split_status", "split_category", "weight_share",
    "rolling_4q_sum", "rolling_pct_change", "chained_index", "index_variance",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_pairs_no_row_windows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    if name not in WINDOWED:
        assert "Window" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["control_totals"](spark, SF_DIR))
    read = re.search(r"ReadSchema: struct<([^>]*l_suppkey[^>]*)>", plan).group(1)
    columns = {c.split(":")[0] for c in read.split(",")} - {"_tmp_metadata_row_index"}
    assert columns == {"l_suppkey", "l_quantity", "l_extendedprice"}


def test_sums_are_combined_before_the_shuffle(spark):
    plan = plan_of(QUERIES["control_totals"](spark, SF_DIR))
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning") < plan.rindex("partial_sum")


def test_all_splits_come_from_one_pass(spark):
    plan = plan_of(QUERIES["split_report"](spark, SF_DIR))
    assert plan.count("Expand") == 1
    assert "lineitem" not in plan  # the sales were read once, into the cube


@pytest.mark.parametrize("name", ["cell_grid_rows", "split_report_rows"])
def test_sales_are_joined_once_for_the_grid(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "lineitem" not in plan and "part.parquet" not in plan


def test_wide_sales_are_joined_to_their_orders_once(without_broadcast):
    plan = plan_of(QUERIES["list_price_join_wide"](without_broadcast, SF_DIR))
    assert "lineitem" not in plan and "orders" not in plan


def broadcast_leaves(plan: str) -> list[str]:
    """Leaf operators below the broadcasts of a plan."""
    found, depth = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if depth is not None and indent <= depth:
            depth = None
        if depth is not None and "Scan" in line:
            found.append(line.strip(" :+-*()0123456789"))
        if depth is None and "BroadcastExchange" in line:
            depth = indent
    return found


def test_small_sides_are_broadcast(spark):
    leaves = broadcast_leaves(plan_of(t.sales(spark, SF_DIR)))
    assert len(leaves) == 4 and all("parquet" in leaf for leaf in leaves)


def test_large_sides_are_not_broadcast(without_broadcast):
    plan = plan_of(t.sales(without_broadcast, SF_DIR))
    assert "SortMergeJoin" in plan
    # Only the short list of hot keys may be.
    assert not any("parquet" in leaf for leaf in broadcast_leaves(plan))


def test_one_load_is_one_partition(spark, tmp_path):
    for n in (1, 2):
        stored.append_load(spark.createDataFrame([(n, 1.0)], "load_id int, value double"), str(tmp_path / "w"))
    plan = plan_of(stored.snapshot(stored.read_warehouse(spark, str(tmp_path / "w")), 2))
    assert re.search(r"PartitionFilters: \[[^\]]*load_id", plan)
