"""Index series: extend by a year, fill the new rows, chain revenue per journey.

A series row is (load_id, publication_status, sector, ticket_category, category_order, label,
label_order, value). Within a (sector, ticket_category) block the rows are one per January and then
the statistics. Every step finds a row by its label, never by its place in the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from indexloom.functions import pct_change, real_change, rolled_forward
from indexloom.operators.usage import chained_index

BLOCK = ["sector", "ticket_category"]
YEAR_LABEL = r"^January (\d{4})$"

# The statistics published for each block, in order.
AVERAGE_CHANGE = "Average change in price (%)"
WEIGHT_SHARE = "Expenditure weights (%) total"
REAL_YEAR_ON_YEAR = "Real terms change in average price year on year"
REAL_SINCE_2004 = "Real terms change in average price year on 2004"
ALL_TICKETS = "All tickets"
REVENUE_PER_JOURNEY = "Revenue per journey"
# Blocks that hold the total, and blocks that hold the deflator.
TOTAL_BLOCKS = [("All operators", "All tickets"), ("All tickets", "All tickets")]
DEFLATOR_BLOCKS = [("RPI", "All items index"), ("RPI (all items)", "RPI (all items)")]


@dataclass(frozen=True)
class SeriesKind:
    """What differs between the published series."""

    name: str
    # The three sectors whose "All tickets" rows make up the total.
    sectors: tuple[str, str, str]
    # First year of the series, if statistic labels carry years.
    start_year: int | None

    def statistics(self, year: int) -> list[str]:
        """Statistic labels of the series that ends with January of `year`, in order."""
        if self.start_year is None:
            return [AVERAGE_CHANGE, WEIGHT_SHARE, REAL_YEAR_ON_YEAR, REAL_SINCE_2004]
        real = "Real terms change in average price"
        return [AVERAGE_CHANGE, WEIGHT_SHARE, f"{real} {year} on {year - 1}", f"{real} {year} on {self.start_year}"]


BY_SECTOR = SeriesKind("ticket_category", ("London and South East", "Long distance", "Regional"), None)
BY_TICKET_TYPE = SeriesKind(
    "ticket_type", ("London and SE operators", "Long-distance operators", "Regional operators"), 1995
)


def series_kind(name: str) -> SeriesKind:
    for kind in (BY_SECTOR, BY_TICKET_TYPE):
        if kind.name == name:
            return kind
    raise ValueError(f"unknown series kind {name!r}")


def label_year() -> Column:
    """Year of a January row, null for the statistics."""
    return F.regexp_extract("label", YEAR_LABEL, 1).try_cast("int")


def latest_value(df: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """Last value of each group in the given order."""
    return df.groupBy(*by).agg(F.max_by(value, order).alias(value))


def last_year(series: DataFrame) -> int:
    """Year of the last January; one number, read to build the labels of the next year."""
    year = series.agg(F.max(label_year())).first()[0]
    if year is None:
        raise ValueError("the series has no January row")
    return year


def relabel(label: Column | str, year: int) -> Column:
    """Move the years in a statistic label on by one, the later of the two first."""
    moved = F.regexp_replace(label, str(year), str(year + 1))
    return F.regexp_replace(moved, str(year - 1), str(year))


def extend_series(series: DataFrame, kind: SeriesKind, publication_status: str = "Approved") -> DataFrame:
    """Append a January and replace the statistics by empty ones for the next year."""
    year = last_year(series)
    statistics = kind.statistics(year)
    position = {label: i for i, label in enumerate(statistics, 1)}
    tail = series.agg(
        F.max(F.when(label_year() == year, F.col("label_order"))).alias("order"), F.max("load_id").alias("load_id")
    ).first()
    is_statistic = F.col("label").isin(statistics)

    years = series.where(~is_statistic)
    january = series.where(label_year() == year).withColumns(
        {
            "label": F.lit(f"January {year + 1}"),
            "label_order": F.lit(tail["order"] + 1),
            "value": F.lit(None).cast("double"),
        }
    )
    place = F.coalesce(*[F.when(F.col("label") == label, F.lit(i)) for label, i in position.items()])
    emptied = series.where(is_statistic).withColumns(
        {
            "label_order": place + F.lit(tail["order"] + 1),
            "label": F.col("label") if kind.start_year is None else relabel("label", year),
            "value": F.lit(None).cast("double"),
        }
    )
    return (
        years.unionByName(january)
        .unionByName(emptied)
        .withColumns({"load_id": F.lit(tail["load_id"] + 1), "publication_status": F.lit(publication_status)})
        .select(*series.columns)
        .orderBy("category_order", "label_order")
    )


def report_for_series(report: DataFrame, keys: DataFrame) -> DataFrame:
    """Report rows under the block they are published in; `keys` maps part to (sector, ticket_category)."""
    return (
        report.select("part", "average_change", "total_weight", "share")
        .join(keys.select("part", *BLOCK), "part")
        .select(*BLOCK, "average_change", "total_weight", "share")
        .distinct()
    )


def all_sector_change(report: DataFrame, sectors: Sequence[str]) -> DataFrame:
    """Weighted change over the three sectors as one row, null if one of them is missing."""
    rows = report.where(F.col("sector").isin(list(sectors)) & (F.col("ticket_category") == ALL_TICKETS))
    weighted = F.col("average_change") * F.col("total_weight").cast("double")
    complete = (F.count_distinct(F.when(weighted.isNotNull(), F.col("sector"))) == len(sectors)) & (
        F.count(weighted) == F.count(F.lit(1))
    )
    return rows.agg(
        F.when(complete, F.try_divide(F.sum(weighted), F.sum(F.col("total_weight").cast("double")))).alias("average_change")
    )


def _in_blocks(blocks: Sequence[tuple[str, str]]) -> Column:
    found = F.lit(False)
    for sector, ticket_category in blocks:
        found = found | ((F.col("sector") == sector) & (F.col("ticket_category") == ticket_category))
    return found


def fill_series(template: DataFrame, report: DataFrame, kind: SeriesKind, deflator: float, year: int | None = None) -> DataFrame:
    """Fill the rows `extend_series` left empty.

    One row per block holds the previous value, the change and the share; the new January and the
    four statistics all follow from it. `deflator` is the yearly rate in percent.
    """
    new_year = last_year(template)
    if year is not None and year != new_year:
        raise ValueError(f"the series continues with {new_year}, not {year}")
    average, weights, year_on_year, since_start = kind.statistics(new_year)
    is_total, is_deflator = _in_blocks(TOTAL_BLOCKS), _in_blocks(DEFLATOR_BLOCKS)

    previous = template.groupBy(*BLOCK).agg(F.max(F.when(label_year() == new_year - 1, F.col("value"))).alias("_previous"))
    total_change = all_sector_change(report, kind.sectors).scalar()
    blocks = (
        previous.join(report, BLOCK, "left")
        .withColumn(
            "_change",
            F.coalesce("average_change", F.when(is_total, total_change), F.when(is_deflator, F.lit(float(deflator)))),
        )
        .withColumn("_share", F.coalesce(F.col("share") * 100, F.when(is_total, F.lit(100.0))))
        .withColumn("_new", rolled_forward(F.col("_previous"), F.col("_change")))
        .select(*BLOCK, "_previous", "_change", "_share", "_new")
    )
    deflator_now = blocks.where(is_deflator).agg(F.max("_new")).scalar()
    filled = (
        F.when(label_year() == new_year, F.col("_new"))
        .when(F.col("label") == average, F.col("_change"))
        .when(F.col("label") == weights, F.col("_share"))
        .when(F.col("label") == year_on_year, real_change(F.col("_new"), F.col("_previous"), F.lit(float(deflator))))
        .when(F.col("label") == since_start, pct_change(F.col("_new"), deflator_now))
    )
    return (
        template.join(blocks, BLOCK, "left")
        .withColumn("value", F.coalesce(filled, F.col("value")))
        .select(*template.columns)
        .orderBy("category_order", "label_order")
    )


def insert_revenue_per_journey(series: DataFrame, changes: DataFrame) -> DataFrame:
    """Rebuild the revenue-per-journey index from its yearly changes.

    Adds `variance`, the published value less the rebuilt one, for review.
    """
    is_block = F.col("ticket_category") == REVENUE_PER_JOURNEY
    joined = series.join(changes.withColumnRenamed("value", "_change"), ["sector", "label"], "left")
    joined = joined.withColumn("_factor", F.when(is_block, F.col("_change")))
    chained = chained_index(joined, "_factor", "_index", ["sector"], ["category_order", "label_order"])
    index = F.when(is_block & (F.col("value") == 100), F.lit(100.0)).otherwise(F.col("_index"))
    new_change = F.lag("_change").over(W.partitionBy(*BLOCK).orderBy("label_order"))
    return (
        chained.withColumn("_index", index)
        .withColumns(
            {
                "variance": F.col("value") - F.col("_index"),
                "value": F.when(is_block & (F.col("label") == AVERAGE_CHANGE), new_change).otherwise(
                    F.coalesce("_index", "value")
                ),
            }
        )
        .select(*series.columns, "variance")
        .orderBy("category_order", "label_order")
    )
