"""Stage 3: split report to the next year of the index series, and its load into the warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from indexloom.operators import series, usage
from indexloom.plans import fixed_values as fixed
from indexloom.session import tune
from indexloom.sources import delimited, tables

# The load column of plain and of published tables.
LOAD_COLUMNS = {False: "load_id", True: "Load_ID"}


def next_series(last: DataFrame, report: DataFrame, keys: DataFrame, kind: series.SeriesKind, deflator: float, year: int | None = None) -> DataFrame:
    """The series one year on: extended and filled from the split report."""
    return series.fill_series(
        series.extend_series(last, kind), series.report_for_series(report, keys), kind, deflator, year
    )


def journey_changes(revenue: DataFrame, journeys: DataFrame) -> DataFrame:
    """Yearly change of revenue per journey from the two usage tables."""
    def quarterly(df: DataFrame, value: str) -> DataFrame:
        rolled = usage.usage_rollup(df, fixed.USAGE_SECTORS, fixed.EXCLUDED_USAGE_SOURCE, fixed.FIRST_USAGE_QUARTER)
        totals = usage.with_total(rolled, fixed.USAGE_TOTAL_PARTS, "All operators")
        return usage.sectors_to_rows(totals, usage.PERIOD, list(fixed.USAGE_NAMES), value)

    both = quarterly(revenue, "revenue").join(quarterly(journeys, "journeys"), [*usage.PERIOD, "sector"])
    return usage.revenue_per_journey_change(both, fixed.USAGE_NAMES)


def loadable(built: DataFrame, table: DataFrame, kind: str) -> DataFrame:
    """A built series with the columns of the warehouse table it goes to, in name, type and order."""
    named = tables.published_series(built, kind) if tables.is_published(table, kind) else built
    return named.select(*[named[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in table.schema])


def run(
    spark: SparkSession, warehouse: dict[str, str], report: DataFrame, keys: DataFrame, revenue: DataFrame, journeys: DataFrame,
    out: str, run_id: str, deflator: float, year: int | None = None, load: bool = True,
    load_id: int | None = None, jdbc: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Build both series and append them to their warehouse tables, one path per series kind.

    They go on from the load `load_id`, by default the latest, which is read from Parquet or over JDBC.
    A load is appended under the column names and types the table has, published or plain.
    """
    tune(spark)
    written = {}
    for kind in (series.BY_SECTOR, series.BY_TICKET_TYPE):
        table = tables.read_warehouse(spark, warehouse[kind.name], jdbc)
        plain = tables.plain_series(table, kind.name)
        # From Parquet, the names of the partitions say which load is the latest; no file is opened for it.
        newest = tables.newest_load(spark, warehouse[kind.name], LOAD_COLUMNS[tables.is_published(table, kind.name)]) if load_id is None and not jdbc else load_id
        last = tables.latest_snapshot(plain) if newest is None else tables.snapshot(plain, newest)
        if last.isEmpty():
            raise ValueError(f"{warehouse[kind.name]} has no load {load_id if load_id is not None else ''}")
        built = next_series(last, report, keys, kind, deflator, year)
        if kind is series.BY_SECTOR:
            built = series.insert_revenue_per_journey(built, journey_changes(revenue, journeys))
        written[kind.name] = tables.write_run(built, out, f"series_{kind.name}", run_id)
        if load:
            tables.append_load(loadable(written[kind.name], table, kind.name), warehouse[kind.name], LOAD_COLUMNS[tables.is_published(table, kind.name)])
    return written


@dataclass(frozen=True)
class Sources:
    """Where the inputs of stage 3 are: the folder of stage 2, the key lookup, the usage views, a warehouse table per series kind."""

    stage2: str
    series_keys: str
    revenue: str
    journeys: str
    warehouse: Mapping[str, str]


def run_from(
    spark: SparkSession, sources: Sources, out: str, run_id: str, deflator: float, year: int | None = None, load: bool = True,
    stage2_run: str | None = None, load_id: int | None = None, jdbc: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Stage 3 on files: the report of a completed run of stage 2 (by default the latest), lookup and usage views.

    With `jdbc` options, the usage views and the warehouse tables are read from the database.
    """
    tune(spark)
    stage2_run = tables.completed_run(spark, sources.stage2, stage2_run)
    report = tables.read_run(spark, sources.stage2, "split_report", stage2_run)
    revenue, journeys = (tables.read_usage(spark, view, jdbc) for view in (sources.revenue, sources.journeys))
    keys = delimited.read_series_keys(spark, sources.series_keys)
    return run(spark, dict(sources.warehouse), report, keys, revenue, journeys, out, run_id, deflator, year, load, load_id, jdbc)
