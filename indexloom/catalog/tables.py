"""The supplied tables read as sales, lookups, prices, feed and index series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.functions import zero_pad
from indexloom.operators import lookups, prices, rollups, series, usage
from indexloom.operators.joins import key_join
from indexloom.operators.lookups import StatusRule
from indexloom.plans import ingest
from indexloom.plans import fixed_values as fixed
from indexloom.session import stage

# The codes of the supplied tables that stand for those of the published index.
SECTOR_BY_REGION = {"AFRICA": "Lon SE", "AMERICA": "Lon SE", "ASIA": "Regional", "EUROPE": "Long D"}
TICKET_TYPE_BY_BRAND = {
    "Brand#1": "Full", "Brand#5": "Full",
    "Brand#2": "Reduced", "Brand#3": "Reduced", "Brand#6": "Reduced", "Brand#7": "Reduced",
    "Brand#4": "Season", "Brand#8": "Season",
}
STATUS_RULES = (
    StatusRule("toc", "flag2", ("O",), "Regulated_by_TOC"),
    StatusRule("products", "product", ("2STA", "2LAR", "3STA", "3ECO", "4LAR", "4MED", "2PRO", "5SMA"), "Regulated_by_Product"),
    StatusRule("exceptions", "product", ("3MED", "4SMA"), "Unregulated_by_Product"),
    StatusRule("class", "class", ("1",), "Unregulated_by_Class"),
    StatusRule("pcc", "region", ("EUROPE",), "Unregulated_by_PCC"),
)
CODES = ingest.Codes(
    sectors=SECTOR_BY_REGION, sector_source="region", ticket_types=TICKET_TYPE_BY_BRAND, status_rules=STATUS_RULES,
)
CATEGORY_BY_TYPE = {"PROMO": "Advance", "LARGE": "Season", "STANDARD": "Anytime", "ECONOMY": "Offpeak", "MEDIUM": "Other"}
EXCLUDED_PRODUCTS = ("2MED", "4STA")
CHECKED_PRODUCTS = ("2STA", "2LAR", "3STA")
WEIGHT_LIMIT = 50_000
LAST_BASE_YEAR = 1997
DEFLATOR = 2.5

PRODUCT_KEY, CLASS_KEY = ingest.PRODUCT_KEY, ingest.CLASS_KEY
SALES_KEY = ["carrier", "region", "origin", "destination", "route", "product", "product_group"]


# The schemas of the supplied tables, so that reading one starts no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def line_codes() -> dict[str, Column]:
    """Destination and route of a line; one of the destinations holds a letter."""
    line = F.when(F.col("l_linenumber") == 7, F.lit("Q7")).otherwise(F.col("l_linenumber").cast("string"))
    return {"destination": zero_pad(line, 4), "route": zero_pad("l_returnflag", 5)}


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the codes they hold themselves. `row` is the place of the row in its file."""
    item = read(spark, sf_dir, "lineitem")
    return item.select(
        F.col("_metadata.row_index").alias("row"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_linestatus", "l_returnflag", "l_discount", "l_quantity", "l_extendedprice", "l_shipdate",
        *[code.alias(name) for name, code in line_codes().items()],
        F.col("l_extendedprice").cast("decimal(18,2)").alias("weight"),
        F.col("l_quantity").alias("journeys"),
        F.year("l_shipdate").alias("year"),
    )


def known(df: DataFrame, *columns: str) -> DataFrame:
    """A code that no table lists becomes Missing, so that no sale is lost."""
    return df.withColumns({c: F.coalesce(c, F.lit(lookups.MISSING)) for c in columns})


def with_nation_key(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return key_join(rows, supplier, ["l_suppkey"], "left", "row")


def with_nation(df: DataFrame, spark: SparkSession, sf_dir: str, salt: str | None = None) -> DataFrame:
    """Carrier, region and origin of a nation."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("carrier"), "n_regionkey")
    region = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    df = key_join(df, nation, ["s_nationkey"], "left", salt)
    df = key_join(df, region, ["n_regionkey"], "left", salt)
    df = df.withColumn("origin", zero_pad(F.col("s_nationkey").cast("string"), 4)).drop("s_nationkey", "n_regionkey")
    return known(df, "carrier", "region", "origin")


def with_region(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier, origin and region of the supplier."""
    return with_nation(with_nation_key(rows, spark, sf_dir), spark, sf_dir, "row")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), product_code().alias("product"), F.col("p_brand").alias("product_group"), "p_type"
    )


def product_code() -> Column:
    return F.concat(F.substring(F.col("p_size").cast("string"), 1, 1), F.upper(F.substring("p_type", 1, 3)))


def with_product(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return known(key_join(rows, parts(spark, sf_dir).drop("p_type"), ["l_partkey"], "left", "row"), "product", "product_group")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per line item. The large tables are joined first, on keys, and what is shuffled for that holds no names yet."""
    rows = lines(spark, sf_dir)
    joined = key_join(
        with_nation_key(rows, spark, sf_dir), parts(spark, sf_dir).drop("p_type"), ["l_partkey"], "left", "row", keys_from=rows
    )
    return with_nation(known(joined, "product", "product_group"), spark, sf_dir, "row")


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of single parts from single suppliers to single customers: about as many keys as sales."""
    buyers = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), zero_pad(F.col("o_custkey").cast("string"), 4).alias("destination"))
    found = key_join(lines(spark, sf_dir).drop("destination"), buyers, ["l_orderkey"], "left", "row")
    found = found.withColumns({"origin": zero_pad(F.col("l_suppkey").cast("string"), 4), "product": F.col("l_partkey").cast("string")})
    return known(found, "origin", "destination", "product")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category of each product and group; small parts have none."""
    named = parts(spark, sf_dir).withColumn("category", lookups.code_label("p_type", CATEGORY_BY_TYPE)).where("category is not null")
    return named.select("product", "product_group", "category").distinct()


def regulated(sales_rows: DataFrame) -> DataFrame:
    """Keys sold without discount, with a flag."""
    undiscounted = sales_rows.where(F.col("l_discount") == 0)
    # The largest code as a number, as text would be sorted and not hashed before it is combined.
    largest = undiscounted.groupBy(*PRODUCT_KEY).agg(F.max(F.ascii("l_linestatus")).alias("code"))
    return largest.select(*PRODUCT_KEY, F.char("code").alias("flag2"))


def is_base() -> Column:
    return F.col("year") <= LAST_BASE_YEAR


def price_sources(which: str) -> dict[str, tuple[Column, Column]]:
    """Receipts and issues behind each price. Closed lines make the list price, undiscounted ones at no charge."""
    listed = F.col("l_linestatus") == "F"
    charged = F.when(F.col("l_discount") > 0, F.col("weight")).otherwise(F.lit(0).cast("decimal(18,2)"))
    found = {}
    for period, rows in (("base", is_base()), ("current", ~is_base())):
        if which in ("derived", "both"):
            found[f"derived_{period}"] = (F.when(rows, F.col("weight")), F.when(rows, F.col("journeys")))
        if which in ("list", "both"):
            found[f"list_{period}"] = (F.when(rows & listed, charged), F.when(rows & listed, F.col("journeys")))
    return found


def price_table(sales_rows: DataFrame, keys: list[str], which: str = "both") -> DataFrame:
    return prices.prices_by_period(sales_rows, keys, price_sources(which))


def fact(spark: SparkSession, sf_dir: str, audit: bool = False) -> DataFrame:
    """Sales row by row with all classifications."""
    rows = sales(spark, sf_dir)
    return classified(rows, regulated(rows), categories(spark, sf_dir), "row", audit)


def classified(rows: DataFrame, regulated_rows: DataFrame, category_rows: DataFrame, salt: str | None, audit: bool = False) -> DataFrame:
    df = lookups.regulated_lookup(ingest.classify(rows, CODES), regulated_rows, PRODUCT_KEY, ["flag2"], salt)
    df = lookups.status_cascade(df, STATUS_RULES, fixed.STATUS_COLLAPSE, fixed.STATUS_START)
    df = lookups.category_lookup(df, category_rows, ["product", "product_group"], salt=salt)
    return df if audit else df.drop(*lookups.audit_columns(STATUS_RULES))


def priced_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-advance sales row by row with their prices, gaps filled."""
    cube = sales_cube(spark, sf_dir, ["product"])
    facts = classified(sales(spark, sf_dir), regulated(cube), categories(spark, sf_dir), "row")
    return ingest.fill_prices(facts, price_table(cube, PRODUCT_KEY), "row")


def sales_cube(spark: SparkSession, sf_dir: str, product_keys: Sequence[str] = ("product", "product_group")) -> DataFrame:
    """Sales summed over everything the index tells apart.

    One pass over the line items feeds the fact weights, the prices and the regulated lookup of the
    index. Codes come from fixed domains, so the size of this frame does not grow with the sales; most
    codes are only derived after the sum.
    """
    rows = lines(spark, sf_dir)
    joined = key_join(
        with_nation_key(rows, spark, sf_dir), parts(spark, sf_dir).drop("p_type"), ["l_partkey"], "left", "row", keys_from=rows
    )
    coded = known(joined, "product", "product_group").select(
        "s_nationkey", "l_linenumber", "l_returnflag", *product_keys, "l_linestatus",
        F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.lit(1.0)).alias("l_discount"),
        F.when(is_base(), F.lit(LAST_BASE_YEAR)).otherwise(F.lit(LAST_BASE_YEAR + 1)).alias("year"),
        "weight", "journeys",
    )
    keys = [c for c in coded.columns if c not in ("weight", "journeys")]
    # Null keys stay: a nation that is not known is named after the sum.
    summed = coded.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in ("weight", "journeys")])
    return stage(with_nation(summed.withColumns(line_codes()), spark, sf_dir))


def index_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Advance detail, non-advance detail and fact weights of the index, all from the cube."""
    cube = sales_cube(spark, sf_dir)
    weights = rollups.sum_by(cube, SALES_KEY, ["weight", "journeys"])
    facts = stage(classified(weights, regulated(cube), categories(spark, sf_dir), None).drop("flag2"))
    advance = ingest.advance_detail(facts, price_table(ingest.classify(cube, CODES), CLASS_KEY, "derived"))
    non_advance = ingest.non_advance_detail(ingest.fill_prices(facts, price_table(cube, PRODUCT_KEY)))
    return advance, non_advance.select(*advance.columns, "status", "category"), facts


# What classifying and pricing a sale looks at.
ROW_COLUMNS = [*SALES_KEY, "l_linestatus", "l_discount", "year", "weight", "journeys"]


def row_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same three frames as `index_inputs`, from the sales row by row, as stage 1 makes them of files.

    The joined sales are written once, and so are the classified ones, as stage 1 does: all that reads them again
    shuffles nothing but sums.
    """
    def placed(written: DataFrame) -> DataFrame:
        return written.withColumn("row", F.col("_metadata.row_index"))

    rows = placed(stage(sales(spark, sf_dir).select(*ROW_COLUMNS)))
    facts = classified(rows, regulated(rows), categories(spark, sf_dir), "row")
    facts = placed(stage(facts.drop("flag2", "l_linestatus", "l_discount", "year", "row")))
    advance = ingest.advance_detail(facts, price_table(ingest.classify(rows, CODES), CLASS_KEY, "derived"))
    non_advance = ingest.non_advance_detail(ingest.fill_prices(facts, price_table(rows, PRODUCT_KEY), "row"))
    return advance, non_advance.select(*advance.columns, "status", "category"), facts


# Feed: orders are flows, line items are fares.


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow records valid until the end of the year of the order."""
    text = F.col("o_custkey").cast("string")
    return read(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 7, "0").alias("flow_id"),
        F.lpad(text, 4, "0").alias("origin"),
        F.lpad("o_orderstatus", 4, "0").alias("destination"),
        F.lpad(F.substring("o_orderpriority", 1, 1), 5, "0").alias("route"),
        F.when(F.year("o_orderdate") == 2001, F.lit("31122999"))
        .otherwise(F.concat(F.lit("3112"), F.year("o_orderdate").cast("string"))).alias("valid_until"),
        F.date_format("o_orderdate", "ddMMyyyy").alias("valid_from"),
        F.col("_metadata.row_index").alias("flow_row"),
    )


def fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select(
        F.lpad(F.col("l_orderkey").cast("string"), 7, "0").alias("flow_id"),
        F.concat(F.lit("T"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("ticket_code"),
        F.round(F.col("weight") * 100, 0).cast("int").alias("fare"),
        "row",
    )


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as text: flows, fares, and a comment line per nation."""
    flow = F.concat(
        F.lit("RF"), "origin", "destination", "route", F.lit("000"), F.lit("A"), F.lit("S"),
        "valid_until", "valid_from", F.lit("ATO"), F.lit("   "), "flow_id",
    )
    fare = F.concat(F.lit("RT"), "flow_id", "ticket_code", F.lpad(F.col("fare").cast("string"), 8, "0"))
    comment = F.concat(F.lit("/!! "), "n_name")
    return (
        flows(spark, sf_dir).select(flow.alias("value"))
        .unionByName(fares(spark, sf_dir).select(fare.alias("value")))
        .unionByName(read(spark, sf_dir, "nation").select(comment.alias("value")))
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket code to product: each ticket is sold under several products."""
    item = read(spark, sf_dir, "lineitem").select("l_linenumber", "l_returnflag").distinct()
    return item.select(
        F.concat(F.lit("T"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("ticket_code"),
        F.concat(F.lit("2SS"), "l_returnflag").alias("product"),
    )


def feed_prices(spark: SparkSession, sf_dir: str, ticket_rows: DataFrame) -> DataFrame:
    """Fares of the latest flows with their products."""
    dated = flows(spark, sf_dir).withColumn("valid_until_date", F.to_date("valid_until", "ddMMyyyy"))
    latest = prices.latest_validity(dated, ingest.FLOW_KEY, "valid_until_date")
    return prices.flow_prices(
        latest.select("flow_id", *ingest.FLOW_KEY, "flow_row"), fares(spark, sf_dir), ticket_rows, "row"
    ).select(*ingest.FLOW_KEY, "flow_id", "ticket_code", "fare", "product", "flow_row", "row")


# Usage: line items by financial quarter, moved on by ten years into the published range.

USAGE_COLUMNS = {
    "Long-distance": ("EUROPE",),
    "London and South East": ("AFRICA", "AMERICA"),
    "Regional": ("ASIA",),
    "Non-franchised": ("MIDDLE EAST",),
}
FIRST_QUARTER = "2005-06 Quarter 2"
EXCLUDED_SOURCE = 7
MEASURES = {"revenue": "weight", "journeys": "journeys"}


def usage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both usage views: one column per measure and sector."""
    month, year = F.month("l_shipdate"), F.year("l_shipdate") + 10
    rows = with_region(lines(spark, sf_dir), spark, sf_dir).withColumn(
        "financial_year_key", F.when(month >= 4, year).otherwise(year - 1)
    )
    next_year = F.lpad(F.pmod(F.col("financial_year_key") + 1, F.lit(100)).cast("string"), 2, "0")
    quarter = F.floor(F.pmod(month - 4, F.lit(12)) / 3) + 1
    label = F.concat(F.col("financial_year_key").cast("string"), F.lit("-"), next_year, F.lit(" Quarter "), quarter.cast("string"))
    status = F.when(F.col("l_returnflag") == "A", "Approved").when(F.col("l_returnflag") == "R", "Published").otherwise("Draft")
    cells = {
        f"{measure} {sector}": F.when(F.col("region").isin(list(regions)), F.col(value))
        for measure, value in MEASURES.items()
        for sector, regions in USAGE_COLUMNS.items()
    }
    return rows.select(
        "financial_year_key", label.alias("year_and_quarter"), F.col("l_linenumber").alias("source_item_id"),
        status.alias("publication_status"), *[c.alias(name) for name, c in cells.items()],
    )


def usage_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    sectors = [f"{measure} {sector}" for measure in MEASURES for sector in USAGE_COLUMNS]
    rolled = usage.usage_rollup(usage_lines(spark, sf_dir), sectors, EXCLUDED_SOURCE, FIRST_QUARTER)
    return rolled.select(*usage.PERIOD, *[F.col(f"`{s}`").cast("double").alias(s) for s in sectors])


def usage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per quarter and sector, the total among them, with both measures."""
    wide = usage_quarters(spark, sf_dir)
    for measure in MEASURES:
        wide = usage.with_total(wide, [f"{measure} {s}" for s in fixed.USAGE_TOTAL_PARTS], f"{measure} All operators")
    names = [*USAGE_COLUMNS, "All operators"]
    # A handful of rows, so the wide frame is read once per measure from the stage.
    wide = stage(wide)
    parts = [
        usage.sectors_to_rows(
            wide.select(*usage.PERIOD, *[F.col(f"`{measure} {n}`").alias(n) for n in names]), usage.PERIOD, names, measure
        )
        for measure in MEASURES
    ]
    return parts[0].join(parts[1], [*usage.PERIOD, "sector"])


# Index series: average price per region and year.

SERIES_REGIONS = ("AFRICA", "EUROPE", "ASIA")
# The total block and the deflator block of each series.
SERIES_BLOCKS = {
    series.BY_SECTOR: (series.TOTAL_BLOCKS[0], series.DEFLATOR_BLOCKS[0]),
    series.BY_TICKET_TYPE: (series.TOTAL_BLOCKS[1], series.DEFLATOR_BLOCKS[1]),
}
SERIES_COLUMNS = ["load_id", "publication_status", "sector", "ticket_category", "category_order", "label", "label_order", "value"]


def yearly_sums(spark: SparkSession, sf_dir: str, kind: series.SeriesKind = series.BY_SECTOR) -> DataFrame:
    """Sums per region and year, a handful of rows that everything below starts from."""
    rows = with_region(lines(spark, sf_dir), spark, sf_dir)
    names = dict(zip(SERIES_REGIONS, kind.sectors, strict=True))
    named = rows.withColumn("sector", F.coalesce(lookups.code_label("region", names), "region"))
    return stage(rollups.sum_by(named, ["sector", "year"], ["weight", "journeys"]))


def yearly_levels(sums: DataFrame, kind: series.SeriesKind = series.BY_SECTOR) -> DataFrame:
    """Average price per block and year: every region, the total, and the total again as deflator."""
    (total_sector, total_category), (deflator_sector, deflator_category) = SERIES_BLOCKS[kind]
    total = sums.groupBy("year").agg(F.sum("weight").alias("weight"), F.sum("journeys").alias("journeys"))
    blocks = [
        (sums, F.col("sector"), "All tickets", 1),
        (total, F.lit(total_sector), total_category, 2),
        (total, F.lit(deflator_sector), deflator_category, 3),
    ]
    frames = [
        df.select(
            sector.alias("sector"), F.lit(category).alias("ticket_category"), F.lit(order).alias("category_order"), "year",
            F.try_divide(F.col("weight").cast("double"), "journeys").alias("value"),
        )
        for df, sector, category, order in blocks
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def index_series(sums: DataFrame, kind: series.SeriesKind = series.BY_SECTOR) -> DataFrame:
    """The series as last published: a January per year, then the statistics."""
    levels = yearly_levels(sums, kind)
    januaries = levels.select(
        "sector", "ticket_category", "category_order",
        F.concat(F.lit("January "), F.col("year").cast("string")).alias("label"),
        (F.col("year") - 1990).alias("label_order"), "value",
    )
    labels = kind.statistics(sums.agg(F.max("year")).first()[0])
    statistics = levels.select("sector", "ticket_category", "category_order").distinct().select(
        "*", F.posexplode(F.array(*[F.lit(label) for label in labels])).alias("place", "label")
    ).select(
        "sector", "ticket_category", "category_order", "label", (F.col("place") + 101).alias("label_order"),
        F.lit(0.0).alias("value"),
    )
    both = januaries.unionByName(statistics)
    return both.withColumns({"load_id": F.lit(7), "publication_status": F.lit("Approved")}).select(*SERIES_COLUMNS)


def series_report(sums: DataFrame) -> DataFrame:
    """Change between the two periods, weight and share per region."""
    def price(rows: Column) -> Column:
        return F.try_divide(F.sum(F.when(rows, F.col("weight"))).cast("double"), F.sum(F.when(rows, F.col("journeys"))))

    parts = sums.groupBy("sector").agg(
        price(is_base()).alias("_base"), price(~is_base()).alias("_current"), F.sum("weight").alias("total_weight")
    )
    total = sums.agg(F.sum("weight").cast("double").alias("weight")).scalar()
    return prices.with_change(parts, "_base", "_current", "average_change").select(
        "sector", F.lit("All tickets").alias("ticket_category"), "average_change", "total_weight",
        F.try_divide(F.col("total_weight").cast("double"), total).alias("share"),
    )


def extended_series(spark: SparkSession, sf_dir: str, kind: series.SeriesKind = series.BY_SECTOR) -> DataFrame:
    return series.extend_series(index_series(yearly_sums(spark, sf_dir, kind), kind), kind)


def filled_series(spark: SparkSession, sf_dir: str, kind: series.SeriesKind = series.BY_SECTOR) -> DataFrame:
    sums = yearly_sums(spark, sf_dir, kind)
    template = stage(series.extend_series(index_series(sums, kind), kind))
    return series.fill_series(template, series_report(sums), kind, DEFLATOR)
