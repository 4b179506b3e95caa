"""One query per operator, over the whole supplied tables.

Row-level results come back as rows; where a result would repeat the input it is summed per key, so
the comparison still covers every row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom import functions as fn
from indexloom.catalog import tables as t
from indexloom.operators import colocated, index, lookups, prices, rollups, series, usage
from indexloom.plans import fixed_values as fixed
from indexloom.plans import increments, ingest, publish, report
from indexloom.session import shared_folder, stage, tasks_for, tune
from indexloom.sources import delimited, feed
from indexloom.sources import tables as stored

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under the name of its function."""
    _REGISTERED[build.__name__] = lambda spark, sf_dir: build(tune(spark), sf_dir)
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def money(c: str) -> Column:
    return F.col(c).cast("double").alias(c)


def rounded(c: str, digits: int = 4) -> Column:
    return F.round(F.col(c).cast("double"), digits).alias(c)


def tally(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and weight per key, null keys included."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("weight").cast("double").alias("weight"))


# Normalising


@query
def clean_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("£"), F.format_number("l_extendedprice", 2))
    item = t.read(spark, sf_dir, "lineitem").withColumn("text", text)
    return item.select("l_orderkey", "l_linenumber", fn.clean_money("text").cast("double").alias("amount"))


def _price_file(rows: DataFrame) -> DataFrame:
    """Receipts as formatted money, issues in three notations of which one is no number."""
    whole = F.col("l_quantity").cast("int").cast("string")
    issues = (
        F.when(F.col("l_returnflag") == "A", whole)
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("1,"), F.lpad(whole, 3, "0")))
        .otherwise(F.concat(F.lit(" "), whole, F.lit(" ")))
    )
    return rows.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("£"), F.format_number("l_extendedprice", 2)).alias("receipts"), issues.alias("issues"),
    )


@query
def clean_currency_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _price_file(t.read(spark, sf_dir, "lineitem"))
    return rows.select(
        "l_orderkey", "l_linenumber",
        delimited.lenient_number("receipts").alias("receipts"),
        delimited.lenient_number("issues", strip_marks=False).alias("issues"),
    )


@query
def zero_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return t.read(spark, sf_dir, "orders").select("o_orderkey", fn.zero_pad(key, 4).alias("code4"), fn.zero_pad(key, 5).alias("code5"))


@query
def regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.sales(spark, sf_dir)
    kept = index.numeric_places(rows.where(fn.has_code("product", fixed.PRODUCT_PATTERN)))
    return tally(kept, ["origin", "destination", "product"])


@query
def not_in_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(index.without_products(t.sales(spark, sf_dir), t.EXCLUDED_PRODUCTS), ["product"])


@query
def split_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.category_lookup(
        t.with_product(t.lines(spark, sf_dir), spark, sf_dir), t.categories(spark, sf_dir), ["product", "product_group"], salt="row"
    )
    branch = F.when(F.col("category") == "advance", "advance").otherwise("non-advance")
    return tally(rows.withColumn("branch", branch), ["branch", "category"])


@query
def fixed_width_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.parse_flows(t.feed_lines(spark, sf_dir)).select(
        "flow_id", "origin", "destination", "route", "status_code", "usage_code", "direction", "carrier",
        "valid_until", "valid_from", F.date_format("valid_until_date", "yyyy-MM-dd").alias("valid_until_date"),
    )


@query
def fixed_width_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.parse_fares(t.feed_lines(spark, sf_dir)).select("flow_id", "ticket_code", "fare")


# Lookups


@query
def map_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.with_region(t.lines(spark, sf_dir), spark, sf_dir)
    return tally(lookups.map_codes(rows, t.SECTOR_BY_REGION, "region", "sector"), ["carrier", "sector"])


@query
def map_ticket_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.with_product(t.lines(spark, sf_dir), spark, sf_dir)
    return tally(lookups.map_codes(rows, t.TICKET_TYPE_BY_BRAND, "product_group", "ticket_type", "Other"), ["product_group", "ticket_type"])


@query
def map_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.with_product(t.lines(spark, sf_dir), spark, sf_dir).withColumn("digit", F.substring("product", 1, 1))
    return tally(lookups.map_codes(rows, fixed.CLASS_BY_DIGIT, "digit", "class", "2"), ["digit", "class"])


@query
def missing_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.category_lookup(
        ingest.classify(t.sales(spark, sf_dir), t.CODES), t.categories(spark, sf_dir), ["product", "product_group"], salt="row"
    )
    return lookups.missing_counts(rows, ["sector", "ticket_type", "class", "category"])


@query
def missing_sector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.map_codes(t.with_region(t.lines(spark, sf_dir), spark, sf_dir), t.SECTOR_BY_REGION, "region", "sector")
    return lookups.missing_rows(rows, "sector").select("l_orderkey", "l_linenumber", "carrier", "region", money("weight"))


@query
def status_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(t.fact(spark, sf_dir), ["carrier", "product", "status"])


@query
def status_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(t.fact(spark, sf_dir, audit=True), [*lookups.audit_columns(t.STATUS_RULES), "status"])


@query
def status_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.fact(spark, sf_dir).select("product", "product_group", "status").distinct()


PRICE_NAMES = [ingest.LIST_BASE, ingest.LIST_CURRENT, ingest.DERIVED_BASE, ingest.DERIVED_CURRENT]


@query
def left_lookup_4key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.sales(spark, sf_dir)
    return tally(lookups.regulated_lookup(rows, t.regulated(rows), t.PRODUCT_KEY, ["flag2"], "row"), [*t.PRODUCT_KEY, "flag2"])


@query
def colocated_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regulated lookup and all four prices attached to sales in buckets of their key; the sales move once, when they are written."""
    rows = stage(t.sales(spark, sf_dir))
    to = colocated.layout(rows, t.PRODUCT_KEY)
    sold = colocated.write_large(rows.select("row", *t.PRODUCT_KEY, "weight"), to, "row")
    for entries in (t.regulated(rows), t.price_table(rows, t.PRODUCT_KEY)):
        sold = colocated.attach(sold, colocated.write_entries(entries, to), to)
    found = sold.groupBy(*t.PRODUCT_KEY, "flag2").agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").cast("double").alias("weight"), *[F.max(c).alias(c) for c in PRICE_NAMES]
    )
    return found.select(*t.PRODUCT_KEY, "flag2", "n", "weight", *[rounded(c) for c in PRICE_NAMES])


@query
def lookup_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = t.sales(spark, sf_dir).select(*t.PRODUCT_KEY, "l_linestatus").where(F.col("l_discount") == 0)
    return lookups.duplicate_keys(listed.distinct(), t.PRODUCT_KEY)


@query
def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.with_product(t.lines(spark, sf_dir), spark, sf_dir)
    found = lookups.category_lookup(rows, t.categories(spark, sf_dir), ["product", "product_group"], salt="row")
    return tally(found, ["product", "product_group", "category"])


@query
def category_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.with_product(t.lines(spark, sf_dir), spark, sf_dir)
    return lookups.unmatched_keys(rows, t.categories(spark, sf_dir), ["product", "product_group"])


LOOKUP_KEY = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What was sold in each of the two periods, as the old and the new version of a lookup."""
    rows = t.lines(spark, sf_dir)
    old, new = (rows.where(period).select(*LOOKUP_KEY).distinct() for period in (t.is_base(), ~t.is_base()))
    return old, new


@query
def lookup_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _versions(spark, sf_dir)
    return lookups.only_in(new, old, LOOKUP_KEY)


@query
def lookup_only_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _versions(spark, sf_dir)
    return lookups.only_in(old, new, LOOKUP_KEY)


# Grouped sums


@query
def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.with_region(t.lines(spark, sf_dir), spark, sf_dir)
    return rollups.control_totals(rows).select("carrier", money("weight"), "journeys")


@query
def advance_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.advance_rollup(t.fact(spark, sf_dir)).select(*rollups.ADVANCE_KEYS, money("weight"), "journeys")


@query
def revenue_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.revenue_by_product(t.fact(spark, sf_dir)).select("carrier", "product", "status", money("weight"))


@query
def revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollups.revenue_by_segment(t.fact(spark, sf_dir))
    return found.select("carrier", *index.CELL, money("weight"))


@query
def weight_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollups.weight_rollup(t.fact(spark, sf_dir))
    return found.select("product", "product_group", *index.CELL, money("weight"))


@query
def season_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollups.season_rollup(t.fact(spark, sf_dir))
    return found.select("category", "product", "sector", "class", "status", money("weight"))


FACT_ROW = ["carrier", "origin", "destination", "route", "product", "product_group", *index.CELL]


@query
def season_unregulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.season_unregulated(t.fact(spark, sf_dir)).select(*FACT_ROW, money("weight"), "journeys")


@query
def season_by_sector_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.season_by_sector_product(t.fact(spark, sf_dir)).select("sector", "product", money("weight"))


@query
def product_od_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rollups.product_od_sum(t.fact(spark, sf_dir), t.CHECKED_PRODUCTS)
    return found.select("product", "origin", "destination", money("weight"))


# Prices


@query
def latest_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = t.flows(spark, sf_dir).withColumn("valid_until_date", F.to_date("valid_until", "ddMMyyyy"))
    return prices.latest_validity(dated, ingest.FLOW_KEY, "valid_until_date").select("flow_id", *ingest.FLOW_KEY, "valid_until")


@query
def flow_fare_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = t.feed_prices(spark, sf_dir, t.tickets(spark, sf_dir)).groupBy("destination", "route", "ticket_code", "product")
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("fare").alias("fare"))


def _first_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = t.tickets(spark, sf_dir).withColumn("place", F.ascii(F.substring("product", 4, 1)))
    return prices.keep_first(tickets, ["ticket_code"], ["place"]).drop("place")


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares in the order of their flow ids; copies of a flow or a fare in the order of the tables."""
    place = F.lit(0).cast("decimal(38,0)")
    for c in ("flow_id", "flow_row", "row"):
        place = (place * F.lit(10**12).cast("decimal(13,0)") + F.col(c).cast("decimal(12,0)")).cast("decimal(38,0)")
    priced = stage(t.feed_prices(spark, sf_dir, _first_products(spark, sf_dir)).withColumn("place", place).drop("flow_row", "row"))
    return prices.keep_first(priced, [*ingest.FLOW_KEY, "ticket_code", "fare"], ["place"]).drop("place")


@query
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir)


@query
def conflicting_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.conflicting_duplicates(stage(_kept(spark, sf_dir)), [*ingest.FLOW_KEY, "ticket_code"])


@query
def derived_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = delimited.derived_price(_price_file(t.read(spark, sf_dir, "lineitem")), "non-advance", "price")
    return found.select("l_orderkey", "l_linenumber", rounded("price"))


@query
def price_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = t.price_table(t.sales(spark, sf_dir), t.PRODUCT_KEY)
    names = [ingest.LIST_BASE, ingest.LIST_CURRENT, ingest.DERIVED_BASE, ingest.DERIVED_CURRENT]
    return found.select(*t.PRODUCT_KEY, *[rounded(c) for c in names])


def _per_key(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows, weight and the attached prices of every key."""
    found = df.groupBy(*t.PRODUCT_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").cast("double").alias("weight"), *[F.max(c).alias(c) for c in names]
    )
    return found.select(*t.PRODUCT_KEY, "n", "weight", *[rounded(c) for c in names])


def _joined(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    rows = t.sales(spark, sf_dir)
    found = prices.attach_prices(rows, t.price_table(rows, t.PRODUCT_KEY, which), t.PRODUCT_KEY, "row")
    return _per_key(found, [f"{which}_base", f"{which}_current"])


@query
def list_price_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "list")


@query
def derived_price_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir, "derived")


def _joined_wide(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Prices of about as many keys as there are sales, of each period in a table of its own."""
    # Four steps below read the sales, so they are joined to their orders once and written.
    rows = stage(t.wide_sales(spark, sf_dir).select("row", *t.PRODUCT_KEY, "l_linestatus", "l_discount", "year", "weight", "journeys"))
    names = [f"{which}_base", f"{which}_current"]
    tables = [t.price_table(rows.where(period), t.PRODUCT_KEY, which).select(*t.PRODUCT_KEY, name) for name, period in zip(names, (t.is_base(), ~t.is_base()), strict=True)]
    found = prices.attach_prices(rows, prices.combine_price_tables(tables, t.PRODUCT_KEY), t.PRODUCT_KEY, "row")
    return _per_key(found, names)


@query
def list_price_join_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_wide(spark, sf_dir, "list")


@query
def derived_price_join_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_wide(spark, sf_dir, "derived")


@query
def derived_price_join_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    advance = t.index_inputs(spark, sf_dir)[0]
    return advance.select(
        *rollups.ADVANCE_KEYS, money("weight"), "journeys", rounded("price_base"), rounded("price_current"), rounded("change")
    )


@query
def price_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_key(t.priced_fact(spark, sf_dir), ["price_base", "price_current"])


@query
def drop_zero_null_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_key(ingest.non_advance_detail(t.priced_fact(spark, sf_dir)), ["price_base", "price_current", "change"])


DETAIL_ROW = [*FACT_ROW, "journeys"]


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.non_advance_detail(t.priced_fact(spark, sf_dir))


def _detail_row(df: DataFrame) -> DataFrame:
    return df.select(*DETAIL_ROW, money("weight"), rounded("price_base"), rounded("price_current"), rounded("change"))


@query
def big_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail_row(prices.large_rises(_detail(spark, sf_dir), t.WEIGHT_LIMIT, ties=["row"]))


@query
def little_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail_row(prices.large_falls(_detail(spark, sf_dir), t.WEIGHT_LIMIT, ties=["row"]))


@query
def big_earners(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prices.heavy_rows(t.priced_fact(spark, sf_dir), t.WEIGHT_LIMIT, ties=["row"])
    return found.select(*DETAIL_ROW, money("weight"), rounded("price_base"), rounded("price_current"))


@query
def outlier_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(index.trim_outliers(_detail(spark, sf_dir)), FACT_ROW)


# Index


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    advance, non_advance, _ = t.index_inputs(spark, sf_dir)
    return tally(index.union_detail(advance, non_advance), ["product", *index.CELL])


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    advance, non_advance, facts = t.index_inputs(spark, sf_dir)
    return report.build_grid(advance, non_advance, facts, t.EXCLUDED_PRODUCTS)


def _grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.build_grid(*t.row_inputs(spark, sf_dir), t.EXCLUDED_PRODUCTS)


def _grid_columns(grid: DataFrame) -> DataFrame:
    return grid.select(*index.CELL, money("priced_weight"), money("total_weight"), rounded("weighted_change"), rounded("contribution", 0))


def _report_columns(grid: DataFrame) -> DataFrame:
    return index.split_report(grid).select(
        "split", "part", *index.CELL, rounded("average_change"), money("total_weight"), rounded("share", 6)
    )


@query
def cell_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid_columns(_grid(spark, sf_dir))


@query
def cell_grid_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes and contributions to the last bit: sums do not depend on the order of rows."""
    return _grid(spark, sf_dir).select(*index.CELL, "weighted_change", "contribution")


@query
def cell_grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell grid without the cube: every sale is classified and priced as a row."""
    return _grid_columns(_grid_rows(spark, sf_dir))


@query
def split_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_columns(_grid(spark, sf_dir))


@query
def split_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report_columns(_grid_rows(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str]) -> DataFrame:
    found = index.split_by(_grid(spark, sf_dir), name, keys)
    return found.select("split", "part", *keys, rounded("average_change"), money("total_weight"), rounded("share", 6))


@query
def split_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "sector1", ["sector"])


@query
def split_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "class", ["class"])


@query
def split_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "regulation", ["status"])


@query
def split_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "category", ["category"])


@query
def weight_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each carrier in the weight of its region."""
    rows = t.with_region(t.lines(spark, sf_dir), spark, sf_dir)
    sums = rollups.sum_by(rows, ["region", "carrier"], ["weight"])
    return sums.select("region", "carrier", F.round(index.weight_share("weight", "region"), 6).alias("share"))


# Usage


@query
def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.usage_quarters(spark, sf_dir).withColumnsRenamed(_plain_names())


def _plain_names() -> dict[str, str]:
    return {
        f"{measure} {sector}": f"{measure}_{sector.lower().replace('-', '_').replace(' ', '_')}"
        for measure in t.MEASURES
        for sector in t.USAGE_COLUMNS
    }


@query
def usage_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.usage_rows(spark, sf_dir).select(*usage.PERIOD, "sector", rounded("revenue", 2), "journeys")


@query
def rolling_4q_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usage.trailing_sum(t.usage_rows(spark, sf_dir), "revenue", "trailing_revenue", ["sector"], usage.PERIOD)
    return rows.select(*usage.PERIOD, "sector", rounded("trailing_revenue", 2))


@query
def rolling_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = usage.revenue_per_journey_change(t.usage_rows(spark, sf_dir), fixed.USAGE_NAMES)
    return found.select("label", "sector", rounded("value"))


@query
def chained_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = usage.revenue_per_journey_change(t.usage_rows(spark, sf_dir), fixed.USAGE_NAMES)
    found = usage.chained_index(changes, "value", "index_value", ["sector"], ["label"])
    return found.select("label", "sector", rounded("value"), rounded("index_value"))


@query
def index_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per journey rebuilt from its changes, against a series that was published before."""
    changes = stage(usage.revenue_per_journey_change(t.usage_rows(spark, sf_dir), fixed.USAGE_NAMES))
    published = changes.select("label", "sector", (F.col("value") + 100).alias("value"))
    labels = published.withColumn("label_order", F.substring("label", 9, 4).cast("int")).withColumns(
        {
            "load_id": F.lit(7),
            "publication_status": F.lit("Approved"),
            "ticket_category": F.lit(series.REVENUE_PER_JOURNEY),
            "category_order": F.lit(9),
        }
    ).select(*t.SERIES_COLUMNS)
    last = labels.groupBy("sector").agg(F.max("label_order").alias("label_order"))
    statistic = last.select(
        F.lit(7).alias("load_id"), F.lit("Approved").alias("publication_status"), "sector",
        F.lit(series.REVENUE_PER_JOURNEY).alias("ticket_category"), F.lit(9).alias("category_order"),
        F.lit(series.AVERAGE_CHANGE).alias("label"), (F.col("label_order") + 1).alias("label_order"),
        F.lit(None).cast("double").alias("value"),
    )
    found = series.insert_revenue_per_journey(labels.unionByName(statistic), changes)
    return found.select("sector", "label", rounded("value"), rounded("variance"))


# Series


def _block_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "load_id", "publication_status", "sector", "ticket_category", "category_order", "label", "label_order", rounded("value")
    )


@query
def series_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_rows(t.extended_series(spark, sf_dir))


@query
def series_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_rows(t.filled_series(spark, sf_dir))


@query
def series_extend_ticket_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_rows(t.extended_series(spark, sf_dir, series.BY_TICKET_TYPE))


@query
def series_fill_ticket_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_rows(t.filled_series(spark, sf_dir, series.BY_TICKET_TYPE))


def _statistic(df: DataFrame, rows: Column) -> DataFrame:
    return df.where(rows).select("sector", "ticket_category", "label", rounded("value"))


@query
def index_roll_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = t.filled_series(spark, sf_dir)
    newest = series.label_year() == series.last_year(filled)
    return _statistic(filled, newest & (F.col("sector") != "RPI"))


@query
def deflator_roll_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistic(t.filled_series(spark, sf_dir), (F.col("sector") == "RPI") & series.label_year().isNotNull())


@query
def real_terms_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistic(t.filled_series(spark, sf_dir), F.col("label") == series.REAL_YEAR_ON_YEAR)


@query
def real_terms_since_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistic(t.filled_series(spark, sf_dir), F.col("label") == series.REAL_SINCE_2004)


@query
def all_sector_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = t.yearly_sums(spark, sf_dir)
    return series.all_sector_change(t.series_report(sums), series.BY_SECTOR.sectors).select(rounded("average_change"))


@query
def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = t.yearly_levels(t.yearly_sums(spark, sf_dir))
    return series.latest_value(levels, series.BLOCK, "value", "year").select(*series.BLOCK, rounded("value"))


@query
def report_for_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows under the block they are published in; every key is listed twice and counts once."""
    report_rows = t.series_report(t.yearly_sums(spark, sf_dir)).withColumnRenamed("sector", "part").drop("ticket_category")
    names = dict(zip(t.SERIES_REGIONS, series.BY_SECTOR.sectors, strict=True))
    listed = t.read(spark, sf_dir, "region").select(lookups.code_label("r_name", names).alias("part")).where("part IS NOT NULL")
    keys = listed.select("part", F.col("part").alias("sector"), F.lit(series.ALL_TICKETS).alias("ticket_category"))
    found = series.report_for_series(report_rows, keys.unionByName(keys))
    return found.select(*series.BLOCK, rounded("average_change"), money("total_weight"), rounded("share", 6))


# Files: the supplied tables are written as the text they stand for, and read back


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _as_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    df.write.options(header=True, encoding=encoding).csv(path)
    return path


@query
def sales_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales in two extracts, one per period, whose columns stand in another order."""
    rows = t.lines(spark, sf_dir)
    columns = [
        F.col("l_linestatus").alias("carrier_toc_code"), F.col("l_suppkey").cast("string").alias("origin_code"),
        F.col("l_linenumber").cast("string").alias("destination_code"), F.col("l_returnflag").alias("route_code"),
        F.col("l_partkey").cast("string").alias("product_code"), F.col("l_returnflag").alias("pro_group_1_code"),
        F.concat(F.lit("£"), F.format_number("weight", 2)).alias("adjusted_earnings"),
        F.format_number("journeys", 1).alias("operating_journeys"),
    ]
    folder = _new_folder(spark)
    _as_csv(rows.where(t.is_base()).select(*columns), f"{folder}/base", "windows-1252")
    _as_csv(rows.where(~t.is_base()).select(*reversed(columns), F.lit("x").alias("extra")), f"{folder}/current", "windows-1252")
    found = delimited.read_sales(spark, f"{folder}/*").groupBy("carrier", *t.PRODUCT_KEY, "product_group")
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").cast("double").alias("weight"), F.sum("journeys").alias("journeys"))


@query
def corrected_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of five extracts, one of which is then replaced: its sales of the first lines are gone. The others are read once."""
    rows = t.lines(spark, sf_dir).select(
        F.col("l_linestatus").alias("carrier_toc_code"), F.col("l_suppkey").cast("string").alias("origin_code"),
        F.col("l_linenumber").cast("string").alias("destination_code"), F.lit("1").alias("route_code"),
        F.concat(F.lit("2AB"), "l_returnflag").alias("product_code"), F.col("l_returnflag").alias("pro_group_1_code"),
        F.col("weight").cast("string").alias("adjusted_earnings"), F.col("journeys").cast("string").alias("operating_journeys"), "l_orderkey", "l_linenumber",
    )
    folder = _new_folder(spark)

    def extract(part: int, of: DataFrame) -> None:
        chosen = of.where(F.col("l_orderkey") % 5 == part).drop("l_orderkey", "l_linenumber")
        chosen.write.mode("overwrite").options(header=True, encoding="windows-1252").csv(f"{folder}/sales/{part}")

    for part in range(5):
        extract(part, rows)
    regulated = spark.createDataFrame([], "origin string, destination string, route string, product string, flag2 string")
    categories = spark.createDataFrame([], "product string, product_group string, category string")

    def refreshed() -> DataFrame:
        return increments.refresh(spark, f"{folder}/sales/*", f"{folder}/store", lambda sales: ingest.build_fact(sales, regulated, categories), "as in the test")

    refreshed()
    extract(2, rows.where("l_linenumber > 1"))
    return refreshed().groupBy("carrier", "product", "product_group").agg(F.sum("weight").cast("double").alias("weight"), F.sum("journeys").alias("journeys"), F.sum("rows").alias("n"))


@query
def feed_file_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List prices of a feed file that also has comments and blank lines."""
    path = _new_folder(spark)
    blank = t.read(spark, sf_dir, "nation").select(F.lit("").alias("value"))
    t.feed_lines(spark, sf_dir).unionByName(blank).write.text(path)
    tickets = t.tickets(spark, sf_dir).withColumn("lookup_seq", F.ascii(F.substring("product", 4, 1)))
    return ingest.list_prices(feed.read_feed(spark, path), tickets)["prices"]


@query
def regulated_lookup_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = t.regulated(t.sales(spark, sf_dir))
    names = {column: name for name, column in delimited.REGULATED_HEADER.items()}
    written = found.withColumns({"ticketa": F.lit("x"), "flaga": F.lit("x")}).withColumnsRenamed(names)
    read = delimited.read_regulated_lookup(spark, _as_csv(written, _new_folder(spark)))
    return read.select(*t.PRODUCT_KEY, "flag2")


@query
def ticket_lookup_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first product of each part in two lookup files, of which the second is by far the larger."""
    entries = t.lines(spark, sf_dir).select(
        F.col("l_partkey").cast("string").alias("ticket"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("sold"),
        "l_orderkey", "l_linenumber",
    )
    folder = _new_folder(spark)
    for name, rows in (("a", entries.where("l_orderkey % 10 = 0")), ("b", entries.where("l_orderkey % 10 <> 0"))):
        # Sorted as a whole, a file for each million rows.
        ordered = rows.repartitionByRange(tasks_for(rows, 1 << 20), "l_orderkey", "l_linenumber").sortWithinPartitions("l_orderkey", "l_linenumber")
        ordered = ordered.select("ticket", "sold")
        _as_csv(ordered, f"{folder}/{name}")
    found = delimited.read_ticket_lookup(spark, f"{folder}/*", "ticket", "sold")
    return prices.keep_first(stage(found), ["ticket_code"], ["lookup_seq"]).select("ticket_code", "product")


@query
def category_lookup_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {column: name for name, column in delimited.CATEGORY_HEADER.items()}
    written = t.categories(spark, sf_dir).withColumn("category", F.upper("category")).withColumnsRenamed(names)
    return delimited.read_category_lookup(spark, _as_csv(written, _new_folder(spark)))


@query
def price_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = t.lines(spark, sf_dir).select(
        F.col("l_linenumber").cast("string").alias("Origin Code"), F.lit("1").alias("Destination Code"), F.lit("1").alias("Route Code"),
        F.col("l_orderkey").cast("string").alias("Product Code"),
        F.concat(F.lit("£"), F.format_number("weight", 2)).alias("NetReceiptSterling"), F.col("journeys").cast("string").alias("Issues"),
    )
    read = delimited.read_price_file(spark, _as_csv(written, _new_folder(spark)), "non-advance", "price")
    return read.select("product", "origin", rounded("price"))


# Warehouse


@query
def newest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of the runs that were completed, which is neither the first nor the last one written."""
    root = _new_folder(spark)
    rows = t.with_region(t.lines(spark, sf_dir), spark, sf_dir)
    for run_id, of_run in (("001", rows.where(t.is_base())), ("002", rows), ("003", rows.where(~t.is_base()))):
        stored.write_run(rollups.control_totals(of_run), root, "totals", run_id)
        if run_id != "003":
            stored.complete_run(spark, root, run_id)
    found = stored.read_run(spark, root, "totals", stored.completed_run(spark, root))
    return found.select("carrier", money("weight"), "journeys")


@query
def warehouse_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last year's series in the warehouse under its published names, the next one appended, the latest read back."""
    path, kind = _new_folder(spark), series.BY_SECTOR
    first = t.index_series(t.yearly_sums(spark, sf_dir), kind)
    stored.append_load(stored.published_series(first, kind.name), path, "Load_ID")
    table = stored.read_warehouse(spark, path)
    stored.append_load(publish.loadable(t.filled_series(spark, sf_dir), table, kind.name), path, "Load_ID")
    return _block_rows(stored.latest_snapshot(stored.plain_series(stored.read_warehouse(spark, path), kind.name)))


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.lines(spark, sf_dir).withColumnRenamed("year", "load_id")


@query
def max_load_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.max_load_id(_loads(spark, sf_dir))


@query
def snapshot_by_load_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored.latest_snapshot(_loads(spark, sf_dir))
    return found.select("load_id", "l_orderkey", "l_linenumber", money("weight"), "journeys")
