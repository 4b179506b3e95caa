"""The list-price feed: one fixed-width text file with flow records and fare records mixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.sources.positions import place_in_files

COMMENT_MARK = "/!!"
FLOW_MARK = "RF"
# 0-based start and end of each field.
FLOW_FIELDS = {
    "origin": (2, 6),
    "destination": (6, 10),
    "route": (10, 15),
    "status_code": (15, 18),
    "usage_code": (18, 19),
    "direction": (19, 20),
    "carrier": (36, 39),
    "valid_until": (20, 28),
    "valid_from": (28, 36),
    "flow_id": (42, 49),
}
FARE_FIELDS = {"flow_id": (2, 9), "ticket_code": (9, 12), "fare": (12, 20)}
# The open end date and the date it stands for when dates are compared.
OPEN_END = "31122999"
LAST_DAY = "31122100"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the feed with their place in it.

    (`file`, `block`, `seq`) orders lines as they stand in the files, which partitions do not; `line_numbers` makes
    one number of them.
    """
    return spark.read.text(path).select("value", *place_in_files())


def feed_records(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").contains(COMMENT_MARK))


def is_flow() -> Column:
    return F.col("value").startswith(FLOW_MARK)


def _fields(lines: DataFrame, fields: dict[str, tuple[int, int]]) -> DataFrame:
    rest = [c for c in lines.columns if c != "value"]
    cut = [F.substring("value", start + 1, end - start).alias(name) for name, (start, end) in fields.items()]
    return lines.select(*cut, *rest)


def parse_flows(lines: DataFrame) -> DataFrame:
    """Flow records with `valid_until_date`, the end date used to pick the latest."""
    flows = _fields(feed_records(lines).where(is_flow()), FLOW_FIELDS)
    until = F.when(F.col("valid_until") == OPEN_END, F.lit(LAST_DAY)).otherwise(F.col("valid_until"))
    return flows.withColumn("valid_until_date", F.to_date(until, "ddMMyyyy"))


def _fare_lines(lines: DataFrame) -> DataFrame:
    return _fields(feed_records(lines).where(~is_flow() & (F.trim("value") != "")).withColumn("line", F.col("value")), FARE_FIELDS)


def parse_fares(lines: DataFrame) -> DataFrame:
    """Fare records; every line that is no flow, comment or blank is one. Fares are in pence.

    A fare that is no number is null here. It only matters on a line that belongs to a flow, where
    `checked_fares` stops the job; `rejected_lines` lists all of them.
    """
    return _fare_lines(lines).drop("line").withColumn("fare", F.trim("fare").try_cast("int"))


def checked_fares(priced: DataFrame) -> DataFrame:
    """Fails on a fare that joined a flow and is no number."""
    return priced.withColumn("fare", F.when(F.col("fare").isNotNull(), F.col("fare")).otherwise(F.raise_error(F.lit("a fare of a flow is no number"))))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines taken for fares whose fare is no number, with their place in the feed."""
    return _fare_lines(lines).where(F.trim("fare").try_cast("int").isNull()).select("line", "file", "block", "seq")
