"""Stage 2: detail and fact to the cell grid and the split report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from indexloom.operators import index, rollups
from indexloom.plans import fixed_values as fixed
from indexloom.plans import ingest
from indexloom.session import tune
from indexloom.sources import tables


def build_grid(advance: DataFrame, non_advance: DataFrame, fact: DataFrame, excluded_products: Sequence[str]) -> DataFrame:
    """The price side leaves out excluded products and outliers; the weight side keeps every row."""
    priced = index.price_side(advance, non_advance, excluded_products)
    return index.cell_grid(priced, index.prepared_weights(fact))


def run(
    spark: SparkSession, stage1: str, out: str, run_id: str, stage1_run: str | None = None,
    excluded_products: Sequence[str] = fixed.EXCLUDED_PRODUCTS,
) -> dict[str, DataFrame]:
    """Build the reports of one run of stage 1, which must be complete: by default the latest such run."""
    tune(spark)
    stage1_run = tables.completed_run(spark, stage1, stage1_run)
    advance, non_advance, fact = (
        tables.read_run(spark, stage1, name, stage1_run) for name in ("advance", "non_advance", "fact")
    )
    fact = fact.select(*ingest.FACT_COLUMNS)
    reviewed = index.without_products(index.numeric_places(index.union_detail(advance, non_advance)), excluded_products)
    grid = tables.write_run(build_grid(advance, non_advance, fact, excluded_products), out, "cell_grid", run_id)
    written = {
        "season_rollup": tables.write_run(rollups.season_rollup(reviewed), out, "season_rollup", run_id),
        "season_unregulated": tables.write_run(rollups.season_unregulated(reviewed), out, "season_unregulated", run_id),
        "cell_grid": grid,
        "split_report": tables.write_run(index.split_report(grid), out, "split_report", run_id),
    }
    tables.complete_run(spark, out, run_id)
    return written
