"""Delimited inputs: sales extracts, lookups, price files. Schemas are always explicit."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexloom.functions import clean_count, clean_money, lenient_number, zero_pad
from indexloom.operators.prices import unit_price
from indexloom.session import stage
from indexloom.sources.positions import line_numbers, place_in_files

# Header of the sales extract and the column each field becomes.
SALES_HEADER = {
    "carrier_toc_code": "carrier",
    "origin_code": "origin",
    "destination_code": "destination",
    "route_code": "route",
    "product_code": "product",
    "pro_group_1_code": "product_group",
    "adjusted_earnings": "weight",
    "operating_journeys": "journeys",
}
# Header of the regulated-fare lookup.
REGULATED_HEADER = {
    "orig": "origin",
    "dest": "destination",
    "route": "route",
    "ticketa": "ticketa",
    "flaga": "flaga",
    "ticket": "product",
    "flag2": "flag2",
}
CATEGORY_HEADER = {"Product Code": "product", "Product Primary Code": "product_group", "Category": "category"}
SERIES_KEY_HEADER = {"final_answers": "part", "Sector": "sector", "Ticket category": "ticket_category"}
# Headers of the price files, whose last key differs by kind.
PRICE_HEADERS = {
    "advance": {"Origin Code": "origin", "Destination Code": "destination", "Route Code": "route", "class": "class",
                "NetReceiptSterling": "receipts", "Issues": "issues"},
    "non-advance": {"Origin Code": "origin", "Destination Code": "destination", "Route Code": "route",
                    "Product Code": "product", "NetReceiptSterling": "receipts", "Issues": "issues"},
}
PLACE_WIDTHS = {"origin": 4, "destination": 4, "route": 5}
# A file up to this size is scanned for its first line; of a larger one only the first lines are read.
SCANNED_BYTES = 4 << 20
_ONE_SPLIT = str(1 << 50)


@contextmanager
def _with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _first_filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank of the one file a task reads; what follows is left unread."""
    for batch in batches:
        for i, line in enumerate(batch.column("line").to_pylist()):
            if line.strip():
                yield batch.slice(i, 1)
                # A short file is read to its end, so that the Python process can be used again.
                next(batches, None)
                return


def first_lines(spark: SparkSession, path: str | list[str]) -> list[Row]:
    """The first line that is not blank of each file of a directory, or of one file: file, line (bytes), one row each.

    Files of some megabytes are scanned, many to a task, and the line with the least position kept. A larger
    file gets a task of its own that stops after its first lines, so the index costs the same whatever
    the files hold. That makes one query for either sort, whose result is one row per file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"), F.col("_metadata.file_size").alias("size"))
    shape = lines.select("file", "line").schema
    small = lines.where(F.col("size") <= SCANNED_BYTES).where(F.trim(F.col("line").cast("string")) != "")
    small = small.withColumn("seq", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("line", "seq").alias("line"))
    found = small.collect()
    large = lines.where(F.col("size") > SCANNED_BYTES).select("file", "line").mapInArrow(_first_filled, shape)
    with _with_settings(spark, {"spark.sql.files.maxPartitionBytes": _ONE_SPLIT, "spark.sql.files.openCostInBytes": _ONE_SPLIT}):
        return found + large.collect()


def header_index(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """Files by header: the column names in order, and the paths of the files that have them so."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first_lines(spark, path):
        text = bytes(row["line"]).decode(encoding).lstrip("\ufeff").rstrip("\r")
        groups.setdefault(tuple(next(csv.reader([text]))), []).append(unquote(row["file"]))
    return {names: sorted(files) for names, files in sorted(groups.items())}


def as_pattern(path: str) -> str:
    """A path that means itself where patterns are allowed."""
    return "".join(f"\\{c}" if c in "\\{},*?[]^" else c for c in path)


def _glob(files: list[str]) -> str | None:
    """A pattern of the names of these files; None if they lie in several directories."""
    if len({f.rpartition("/")[0] for f in files}) > 1:
        return None
    return "{" + ",".join(as_pattern(f.rpartition("/")[2]) for f in files) + "}"


def read_named_csv(spark: SparkSession, path: str | list[str], header: Mapping[str, str], encoding: str = "UTF-8", placed: bool = False) -> DataFrame:
    """Read the named columns of one file, of several, or of all files of a directory, as text; `placed` adds where a row stands.

    Files may carry other columns as well, and each may have its columns in an order of its own: files
    with the same header are read together, under the schema that the header gives (`header_index`). A file
    without a line is passed over, one without a named column fails.
    """
    groups = header_index(spark, path, encoding)
    if not groups:
        raise ValueError(f"no header in {path}")
    read = []
    for names, files in groups.items():
        # Other columns are never read; their names may repeat or be missing.
        fields = [n if n in header else f"_column_{i}" for i, n in enumerate(names)]
        reader = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in fields])).options(header=True, encoding=encoding)
        glob = _glob([f for same in groups.values() for f in same]) and _glob(files)
        if len(groups) == 1:
            rows = reader.csv(path)
        elif glob:
            # The folder is listed as a whole; a list of many paths would cost a job.
            rows = reader.option("pathGlobFilter", glob).csv(path)
        else:
            rows = reader.csv([as_pattern(f) for f in files])
        read.append(rows.select(*[F.col(f"`{name}`").alias(to) for name, to in header.items()], *(place_in_files() if placed else [])))
    return reduce(DataFrame.unionByName, read)


def padded_places(df: DataFrame) -> DataFrame:
    return df.withColumns({c: zero_pad(c, width) for c, width in PLACE_WIDTHS.items()})


def read_sales(spark: SparkSession, path: str | list[str], placed: bool = False) -> DataFrame:
    """All sales extracts of a directory as one frame; bad currency text fails the job."""
    raw = read_named_csv(spark, path, SALES_HEADER, "windows-1252", placed)
    return padded_places(raw.withColumns({"weight": clean_money("weight"), "journeys": clean_count("journeys")}))


def read_regulated_lookup(spark: SparkSession, path: str) -> DataFrame:
    return padded_places(read_named_csv(spark, path, REGULATED_HEADER))


def read_category_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_named_csv(spark, path, CATEGORY_HEADER).withColumn("category", F.lower("category"))


def read_series_keys(spark: SparkSession, path: str) -> DataFrame:
    """Part of the split report to the series block it is published in."""
    return read_named_csv(spark, path, SERIES_KEY_HEADER)


def read_ticket_lookup(spark: SparkSession, path: str, ticket_column: str, product_column: str) -> DataFrame:
    """Ticket code to product code. `lookup_seq` numbers the entries by file name and place in the file."""
    rows = read_named_csv(spark, path, {ticket_column: "ticket_code", product_column: "product"}, placed=True)
    return line_numbers(stage(rows), "lookup_seq")


def derived_price(df: DataFrame, kind: str, target: str) -> DataFrame:
    """Price in pence from receipts and issues given as text.

    Text that is no number gives no price. Thousands marks are stripped from the receipts of
    non-advance files only, and never from issues.
    """
    receipts: Column = lenient_number("receipts", strip_marks=kind == "non-advance")
    issues = lenient_number("issues", strip_marks=False)
    return df.withColumn(target, unit_price(receipts, issues)).drop("receipts", "issues")


def read_price_file(spark: SparkSession, path: str, kind: str, target: str) -> DataFrame:
    """Derived prices of one year, keyed by class (advance) or by product (non-advance)."""
    if kind not in PRICE_HEADERS:
        raise ValueError(f"price files are 'advance' or 'non-advance', not {kind!r}")
    return derived_price(padded_places(read_named_csv(spark, path, PRICE_HEADERS[kind])), kind, target)
