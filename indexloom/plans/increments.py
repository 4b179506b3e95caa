"""The small reports of stage 1, kept up to date extract by extract."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexloom.operators import rollups
from indexloom.plans import ingest
from indexloom.session import tune
from indexloom.sources import delimited, tables

DONE_SCHEMA = "extract string, version string, run string"


def fingerprint(*frames: DataFrame) -> str:
    """Changes with the rows of the frames, not with their order."""
    told = [tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)), F.sum(F.xxhash64(F.lit(7), *df.columns).cast("decimal(38,0)"))).first()) for df in frames]
    return hashlib.sha256(repr(told).encode()).hexdigest()[:16]


def _done(spark: SparkSession, store: str) -> DataFrame:
    try:
        return spark.read.schema(DONE_SCHEMA).parquet(f"{store}/done")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DONE_SCHEMA)


def present_extracts(spark: SparkSession, sales: str, rules: str) -> dict[str, str]:
    """Extracts of a folder and their versions, which change with a file's time and length and with the rules. Files are listed, not opened."""
    files = spark.read.format("binaryFile").load(sales).select("path", F.unix_micros("modificationTime").alias("at"), "length")
    return {r["path"]: hashlib.sha256(f"{r['at']} {r['length']} {rules}".encode()).hexdigest()[:16] for r in files.collect()}


def refresh(spark: SparkSession, sales: str, store: str, classify: Callable[[DataFrame], DataFrame], rules: str) -> DataFrame:
    """The sums of `rollups.report_sums` over all extracts now in the folder `sales`, reading only those that are new or changed.

    `store` keeps the sums of every extract and version apart. They are sums of whole extracts over keys from fixed code domains, so the
    store stays small, and they add up: a corrected extract takes the place of its former self, one that is gone drops out,
    and the others are not read again. `classify` makes the fact's columns of sales rows; `rules` is a text that changes
    with it and its lookups, and then everything is read again. Sums are written first and noted as done
    afterwards, with the run that wrote them, so what an interrupted run left behind is never counted.
    """
    present = present_extracts(spark, sales, rules)
    known = {(r["extract"], r["version"]): r["run"] for r in _done(spark, store).collect()}
    missing = sorted(path for path, version in present.items() if (path, version) not in known)
    if missing:
        run = uuid.uuid4().hex
        rows = classify(delimited.read_sales(spark, [delimited.as_pattern(path) for path in missing], placed=True))
        # A scan tells its file as an encoded address, in which a plus sign is itself.
        rows = rows.withColumn("extract", F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))))
        sums = rows.groupBy("extract", *rollups.REPORT_KEYS).agg(F.sum("weight").alias("weight"), F.sum("journeys").alias("journeys"), F.count(F.lit(1)).alias("rows"))
        sums.write.parquet(f"{store}/sums/run={run}")
        spark.createDataFrame([(path, present[path], run) for path in missing], DONE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{store}/done")
        known |= {(path, present[path]): run for path in missing}
    if not present:
        raise ValueError(f"no extract in {sales}")
    # One row per extract.
    wanted = spark.createDataFrame([(path, known[path, version]) for path, version in present.items()], "extract string, run string")
    kept = spark.read.option("basePath", f"{store}/sums").parquet(*[f"{store}/sums/run={r}" for r in sorted({known[x] for x in present.items()})])
    kept = kept.withColumn("run", F.col("run").cast("string")).join(wanted, ["extract", "run"], "left_semi")
    return kept.groupBy(*rollups.REPORT_KEYS).agg(F.sum("weight").alias("weight"), F.sum("journeys").alias("journeys"), F.sum("rows").alias("rows"))


def run(spark: SparkSession, sales: str, regulated: str, categories: str, store: str, out: str, run_id: str, codes: ingest.Codes | None = None) -> dict[str, DataFrame]:
    """Control totals and revenue reports after a change of some extracts, written under `out`."""
    tune(spark)
    codes = codes or ingest.Codes()
    lookup, named = delimited.read_regulated_lookup(spark, regulated), delimited.read_category_lookup(spark, categories)
    summed = refresh(spark, sales, store, lambda rows: ingest.build_fact(rows, lookup, named, codes), f"{fingerprint(lookup, named)} {codes!r}")
    summed = tables.write_run(summed, out, "report_sums", run_id)
    reports = {
        "control_totals": rollups.control_totals(summed),
        "revenue_by_product": rollups.revenue_by_product(summed),
        "revenue_by_segment": rollups.revenue_by_segment(summed),
        "season_by_sector_product": rollups.season_by_sector_product(summed),
    }
    return {"report_sums": summed} | {name: tables.write_run(df, out, name, run_id) for name, df in reports.items()}
