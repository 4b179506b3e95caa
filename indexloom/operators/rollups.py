"""Grouped sums over the fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have all keys; plain null tests, which are pushed down to the files."""
    return df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum measures per key. Rows with a null key are left out and a sum over nulls only is 0."""
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    return with_keys(df, keys).groupBy(*keys).agg(*sums)


REPORT_KEYS = ["carrier", "product", "product_group", "sector", "ticket_type", "class", "category", "status"]


def report_sums(fact: DataFrame) -> DataFrame:
    """Weight, journeys and rows over all that the small reports tell apart, null keys included.

    The keys are codes from fixed domains, so the reports that start from here cost one pass over the fact.
    """
    return fact.groupBy(*REPORT_KEYS).agg(F.sum("weight").alias("weight"), F.sum("journeys").alias("journeys"), F.count(F.lit(1)).alias("rows"))


def control_totals(fact: DataFrame) -> DataFrame:
    return sum_by(fact, ["carrier"], ["weight", "journeys"])


ADVANCE_KEYS = ["carrier", "origin", "destination", "route", "product", "product_group", "class", "sector"]


def advance_rollup(fact: DataFrame) -> DataFrame:
    return sum_by(fact.where(F.col("category") == "advance"), ADVANCE_KEYS, ["weight", "journeys"])


def revenue_by_product(fact: DataFrame) -> DataFrame:
    return sum_by(fact, ["carrier", "product", "status"], ["weight"])


def revenue_by_segment(fact: DataFrame) -> DataFrame:
    return sum_by(fact, ["carrier", "sector", "class", "category", "status"], ["weight"])


def weight_rollup(fact: DataFrame) -> DataFrame:
    return sum_by(fact, ["product", "product_group", "sector", "class", "category", "status"], ["weight"])


def season_rollup(fact: DataFrame) -> DataFrame:
    return sum_by(fact.where(F.col("category") == "season"), ["category", "product", "sector", "class", "status"], ["weight"])


def season_unregulated(fact: DataFrame) -> DataFrame:
    return fact.where((F.col("category") == "season") & (F.col("status") == "Unregulated"))


def season_by_sector_product(fact: DataFrame) -> DataFrame:
    return sum_by(fact.where(F.col("category") == "season"), ["sector", "product"], ["weight"])


def product_od_sum(fact: DataFrame, products: Sequence[str]) -> DataFrame:
    chosen = fact.where(F.col("product").isin(list(products)) & (F.col("status") == "Regulated"))
    return sum_by(chosen, ["product", "origin", "destination"], ["weight"])


def category_branch(fact: DataFrame, advance: bool) -> DataFrame:
    is_advance: Column = F.col("category") == "advance"
    return fact.where(is_advance if advance else ~is_advance)
