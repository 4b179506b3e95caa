"""Stage 1: sales extracts, lookups and prices to the fact and the two detail tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.functions import has_code
from indexloom.operators import lookups, prices, rollups
from indexloom.plans import fixed_values as fixed
from indexloom.session import stage, tune
from indexloom.sources import delimited, feed, positions, tables

FLOW_KEY = ["origin", "destination", "route"]
PRODUCT_KEY = [*FLOW_KEY, "product"]
CLASS_KEY = [*FLOW_KEY, "class"]
FACT_COLUMNS = [
    "carrier", "origin", "destination", "route", "product", "product_group", "weight", "journeys",
    "sector", "ticket_type", "class", "status", "category",
]
LIST_BASE, LIST_CURRENT = "list_base", "list_current"
DERIVED_BASE, DERIVED_CURRENT = "derived_base", "derived_current"


@dataclass(frozen=True)
class Codes:
    """Codes that classify a sale; the defaults are those of the published index."""

    sectors: Mapping[str, str] = field(default_factory=lambda: fixed.SECTOR_BY_CARRIER)
    sector_source: str = "carrier"
    ticket_types: Mapping[str, str] = field(default_factory=lambda: fixed.TICKET_TYPE_BY_GROUP)
    classes: Mapping[str, str] = field(default_factory=lambda: fixed.CLASS_BY_DIGIT)
    status_rules: Sequence[lookups.StatusRule] = fixed.STATUS_RULES
    product_pattern: str = fixed.PRODUCT_PATTERN


def classify(sales: DataFrame, codes: Codes) -> DataFrame:
    """Sector, ticket type and class, which depend on the row alone."""
    df = lookups.map_codes(sales, codes.sectors, codes.sector_source, "sector")
    df = lookups.map_codes(df, codes.ticket_types, "product_group", "ticket_type", "Other")
    df = df.withColumn("_digit", F.substring("product", 1, 1))
    return lookups.map_codes(df, codes.classes, "_digit", "class", "2").drop("_digit")


def build_fact(
    sales: DataFrame,
    regulated: DataFrame,
    categories: DataFrame,
    codes: Codes | None = None,
    salt: Column | str | None = None,
) -> DataFrame:
    """Sales rows with all their classifications and the audit columns of the status cascade."""
    codes = codes or Codes()
    df = classify(sales.where(has_code("product", codes.product_pattern)), codes)
    df = lookups.regulated_lookup(df, regulated, PRODUCT_KEY, ["flag2"], salt)
    df = lookups.status_cascade(df, codes.status_rules, fixed.STATUS_COLLAPSE, fixed.STATUS_START)
    return lookups.category_lookup(df, categories, ["product", "product_group"], salt=salt)


def list_prices(lines: DataFrame, tickets: DataFrame) -> dict[str, DataFrame]:
    """Prices of one feed: the table that is joined, and what is to be looked at: all flows and fares with their
    products, duplicates with different fares, and lines that are none."""
    # Both are read more than once below; the text is read once for each, and written before lines are numbered.
    flows = positions.line_numbers(stage(feed.parse_flows(lines)), "flow_line")
    fares = positions.line_numbers(stage(feed.parse_fares(lines)), "fare_line")
    latest = prices.latest_validity(flows, FLOW_KEY, "valid_until_date", "flow_line")
    # Of a ticket's products only the first would be kept below, so the others need not be joined.
    first = prices.keep_first(tickets, ["ticket_code"], ["lookup_seq"])
    priced = feed.checked_fares(prices.flow_prices(latest, fares, first, "fare_line"))
    placed = stage(priced.withColumn("place", positions.first_then("flow_line", "fare_line")))
    kept = stage(prices.keep_first(placed, [*FLOW_KEY, "ticket_code", "fare"], ["place"]).drop("place"))
    return {
        "prices": kept.select(*PRODUCT_KEY, F.col("fare").cast("double").alias("fare")),
        "combined": kept.select(*FLOW_KEY, "carrier", "flow_id", "valid_from", "valid_until", "ticket_code", "fare", "product"),
        "conflicts": prices.conflicting_duplicates(kept, [*FLOW_KEY, "ticket_code"]),
        "rejects": feed.rejected_lines(lines),
    }


def advance_detail(fact: DataFrame, price_table: DataFrame) -> DataFrame:
    """Advance sales summed to their keys, with both derived prices and the change."""
    rolled = rollups.advance_rollup(fact)
    priced = prices.attach_prices(rolled, price_table, CLASS_KEY)
    priced = priced.withColumnsRenamed({DERIVED_BASE: "price_base", DERIVED_CURRENT: "price_current"})
    return prices.with_change(prices.drop_unpriced(priced, "price_base", "price_current"), "price_base", "price_current")


def fill_prices(fact: DataFrame, price_table: DataFrame, salt: Column | str | None = None) -> DataFrame:
    """Non-advance sales row by row, with list prices and derived prices in their gaps."""
    priced = prices.attach_prices(rollups.category_branch(fact, advance=False), price_table, PRODUCT_KEY, salt)
    priced = prices.fill_gaps(priced, LIST_BASE, DERIVED_BASE, "price_base")
    priced = prices.fill_gaps(priced, LIST_CURRENT, DERIVED_CURRENT, "price_current")
    return priced.drop(LIST_BASE, LIST_CURRENT, DERIVED_BASE, DERIVED_CURRENT)


def non_advance_detail(filled: DataFrame) -> DataFrame:
    return prices.with_change(prices.drop_unpriced(filled, "price_base", "price_current"), "price_base", "price_current")


def _with_row(written: DataFrame) -> DataFrame:
    """A written table with the position of each row in its file."""
    return written.withColumn("_row", F.col("_metadata.row_index"))


@dataclass(frozen=True)
class Inputs:
    """Where the inputs of stage 1 are."""

    sales: str
    regulated: str
    categories: str
    tickets: str
    feed_base: str
    feed_current: str
    advance_base: str
    advance_current: str
    non_advance_base: str
    non_advance_current: str
    # The regulated lookup of the year before, if the two are to be compared.
    regulated_before: str | None = None


def compare_regulated(spark: SparkSession, now: str, before: str, out: str, run_id: str) -> dict[str, DataFrame]:
    """Entries of the regulated lookup that only its present or only its former version has."""
    new, old = (delimited.read_regulated_lookup(spark, path) for path in (now, before))
    return {
        "regulated_only_new": tables.write_run(lookups.only_in(new, old, PRODUCT_KEY), out, "regulated_only_new", run_id),
        "regulated_only_old": tables.write_run(lookups.only_in(old, new, PRODUCT_KEY), out, "regulated_only_old", run_id),
    }


def run(spark: SparkSession, inputs: Inputs, out: str, run_id: str, codes: Codes | None = None) -> dict[str, DataFrame]:
    """Run stage 1 and write every result and review table under `out`.

    The fact is written once, with its audit columns, and read back by all that follows, which reads only
    the columns it needs.
    """
    tune(spark)

    def save(df: DataFrame, name: str) -> DataFrame:
        return tables.write_run(df, out, name, run_id)

    codes = codes or Codes()
    regulated = delimited.read_regulated_lookup(spark, inputs.regulated)
    categories = delimited.read_category_lookup(spark, inputs.categories)
    # Parsed once: the joins below count keys on it and read it again, and its rows have places that stay the same.
    sales = _with_row(stage(delimited.read_sales(spark, inputs.sales)))
    classified = build_fact(sales, regulated, categories, codes, "_row").drop("_row", "flag2")
    audited = save(classified, "fact")
    fact = audited.select(*FACT_COLUMNS)

    summed = stage(rollups.report_sums(fact))
    missing = lookups.missing_counts(summed, ["sector", "ticket_type", "class", "category"], "rows")

    written = {
        "fact": fact,
        "status_audit": audited,
        "status_check": save(summed.select("product", "product_group", "status").distinct(), "status_check"),
        "missing_categories": save(
            lookups.missing_rows(summed, "category").select("product", "product_group").distinct(), "missing_categories"
        ),
        "missing_sectors": save(lookups.missing_rows(fact, "sector"), "missing_sectors"),
        "missing_counts": save(missing, "missing_counts"),
        "regulated_duplicates": save(lookups.duplicate_keys(regulated, PRODUCT_KEY), "regulated_duplicates"),
        "control_totals": save(rollups.control_totals(summed), "control_totals"),
        "revenue_by_product": save(rollups.revenue_by_product(summed), "revenue_by_product"),
        "revenue_by_segment": save(rollups.revenue_by_segment(summed), "revenue_by_segment"),
        "season_by_sector_product": save(rollups.season_by_sector_product(summed), "season_by_sector_product"),
        "product_check": save(rollups.product_od_sum(fact, fixed.CHECKED_PRODUCTS), "product_check"),
    }
    if inputs.regulated_before:
        written |= compare_regulated(spark, inputs.regulated, inputs.regulated_before, out, run_id)

    advance_prices = prices.combine_price_tables(
        [
            delimited.read_price_file(spark, inputs.advance_base, "advance", DERIVED_BASE),
            delimited.read_price_file(spark, inputs.advance_current, "advance", DERIVED_CURRENT),
        ],
        CLASS_KEY,
    )
    written["advance"] = save(advance_detail(fact, advance_prices), "advance")

    tickets = delimited.read_ticket_lookup(spark, inputs.tickets, *fixed.TICKET_LOOKUP_COLUMNS)
    listed = {}
    for name, path in ((LIST_BASE, inputs.feed_base), (LIST_CURRENT, inputs.feed_current)):
        found = list_prices(feed.read_feed(spark, path), tickets)
        listed[name] = save(found["prices"].withColumnRenamed("fare", name), name)
        for review in ("combined", "conflicts", "rejects"):
            written[f"{name}_{review}"] = save(found[review], f"{name}_{review}")
    price_table = stage(prices.combine_price_tables(
        [
            listed[LIST_BASE],
            listed[LIST_CURRENT],
            delimited.read_price_file(spark, inputs.non_advance_base, "non-advance", DERIVED_BASE),
            delimited.read_price_file(spark, inputs.non_advance_current, "non-advance", DERIVED_CURRENT),
        ],
        PRODUCT_KEY,
    ))
    detail = save(non_advance_detail(fill_prices(_with_row(fact), price_table, "_row")).drop("_row"), "non_advance")
    written["non_advance"] = detail
    # Heavy rows are wanted with or without prices. They are few, so prices are attached to them once more.
    heavy = _with_row(fact).where(F.col("weight") > fixed.WEIGHT_LIMIT)
    reviews = {
        "large_rises": prices.large_rises(_with_row(detail), fixed.WEIGHT_LIMIT, fixed.CHANGE_LIMIT, ["_row"]),
        "large_falls": prices.large_falls(_with_row(detail), fixed.WEIGHT_LIMIT, fixed.CHANGE_LIMIT, ["_row"]),
        "heavy_rows": prices.heavy_rows(fill_prices(heavy, price_table, "_row"), fixed.WEIGHT_LIMIT, ["_row"]),
    }
    written.update({name: save(df.drop("_row"), name) for name, df in reviews.items()})
    tables.complete_run(spark, out, run_id)
    return written
