"""Quarterly usage: filtered sums, trailing years, revenue per journey, its change and its chained index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from indexloom.functions import pct_change

PERIOD = ["financial_year_key", "year_and_quarter"]


def usage_rollup(
    df: DataFrame,
    sectors: Sequence[str],
    exclude_source: int,
    first_quarter: str,
    statuses: Sequence[str] = ("published", "approved"),
) -> DataFrame:
    """Sum the sector columns per quarter over the wanted rows. Status is compared without regard to case."""
    wanted = (
        (F.col("source_item_id") != exclude_source)
        & F.lower("publication_status").isin([s.lower() for s in statuses])
        & (F.col("year_and_quarter") >= first_quarter)
    )
    return df.where(wanted).groupBy(*PERIOD).agg(*[F.sum(s).alias(s) for s in sectors]).orderBy(*PERIOD)


def with_total(df: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Add the sum of some columns, null if one of them is."""
    first, *others = [F.col(p) for p in parts]
    return df.withColumn(total, sum(others, first))


def sectors_to_rows(df: DataFrame, ids: Sequence[str], sectors: Sequence[str], value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(sectors), "sector", value)


def trailing_sum(df: DataFrame, value: str, target: str, by: Sequence[str], order: Sequence[str], rows: int = 4) -> DataFrame:
    """Sum of the last `rows` rows of a series, null unless all of them have a value."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn(target, F.when(F.count(value).over(w) == rows, F.sum(value).over(w)))


def change_on_previous(df: DataFrame, value: str, target: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Change on the row before in percent, with gaps filled by the last known value first."""
    w = W.partitionBy(*by).orderBy(*order)
    known = F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    return (
        df.withColumn("_known", known)
        .withColumn(target, pct_change(F.col("_known"), F.lag("_known").over(w)))
        .drop("_known")
    )


def chained_index(df: DataFrame, change: str, target: str, by: Sequence[str], order: Sequence[str], base: float = 100.0) -> DataFrame:
    """Chain percentage changes into an index; rows without a change get none and do not move it."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    index = F.product((F.col(change) + 100) / 100).over(w) * base
    return df.withColumn(target, F.when(F.col(change).isNotNull(), index))


def revenue_per_journey_change(quarterly: DataFrame, names: Mapping[str, str], quarter: str = "Quarter 3") -> DataFrame:
    """Yearly change of trailing-year revenue per journey by sector, labelled with the January it is published for.

    `quarterly` has one row per quarter and sector with `revenue` and `journeys`; `names` maps its
    sectors to the published ones. A year in which one sector has no change is left out for all.
    """
    rows = quarterly.where(F.col("sector").isin(list(names)))
    for measure in ("revenue", "journeys"):
        rows = trailing_sum(rows, measure, measure, ["sector"], PERIOD)
    yearly = rows.where(F.col("year_and_quarter").contains(quarter)).withColumn("ratio", F.try_divide("revenue", "journeys"))
    changes = change_on_previous(yearly, "ratio", "value", ["sector"], PERIOD)
    complete = F.count("value").over(W.partitionBy(*PERIOD)) == len(names)
    label = F.concat(F.lit("January 20"), F.substring("year_and_quarter", 6, 2))
    sector = F.coalesce(*[F.when(F.col("sector") == column, F.lit(name)) for column, name in names.items()])
    return changes.withColumn("_complete", complete).where("_complete").select(label.alias("label"), sector.alias("sector"), "value")
