"""Prices of two periods: validity, duplicates, attaching, gap filling, change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexloom.functions import null_if_zero, pct_change
from indexloom.operators.joins import full_join, key_join
from indexloom.operators.rollups import with_keys
from indexloom.session import stage, tasks_for


def latest_validity(flows: DataFrame, keys: Sequence[str], until: str, salt: Column | str | None = None) -> DataFrame:
    """Rows that carry the latest end date of their key; ties all stay.

    The maximum comes from a grouped aggregate that is combined before the shuffle, so a key with
    very many rows never has to be gathered and sorted in one task as a window would do.
    """
    last = flows.groupBy(*keys).agg(F.max(until).alias(until))
    return key_join(flows, last, [*keys, until], "left_semi", salt)


def flow_prices(flows: DataFrame, fares: DataFrame, tickets: DataFrame, salt: Column | str | None = None) -> DataFrame:
    """Fares with their flow, and with the products sold under each ticket code where any is known."""
    priced = key_join(fares, flows, ["flow_id"], "inner", salt)
    return key_join(priced, tickets, ["ticket_code"], "left", salt)


def key_summary(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Per key, null included: `first` (least position) and `entries`.

    Positions are numbers, so the sums are kept by hashing on the map side, and a key with very many
    entries is one row per task before anything is shuffled.
    """
    return df.groupBy(*keys).agg(F.min(position).alias("first"), F.count(F.lit(1)).alias("entries"))


def keep_first(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """One row per key, the first by `position`: a number that no two rows of a key share, such as a line number.

    The frame is counted and read twice, once for its keys and positions alone; a written table is best. Rows are fetched
    by key and position together, which do not repeat, so no key of that join is hot. The join sorts whole rows, in as many
    tasks as there are rows for: left to Spark they would be as many as it has cores, and each would hold more of a larger table.
    """
    (place,) = position
    # As a struct, null keys are equal.
    first = key_summary(df, keys, place).select(F.col("first").alias("_first"), F.struct(*keys).alias("_of_key"))
    n = max(df.sparkSession.sparkContext.defaultParallelism, tasks_for(df))
    rows = df.withColumn("_key", F.struct(*keys)).repartition(n, place, "_key")
    same = (F.col(place) == F.col("_first")) & (F.col("_key") == F.col("_of_key"))
    return rows.join(first.repartition(n, "_first", "_of_key"), same, "left_semi").drop("_key")


def conflicting_duplicates(df: DataFrame, keys: Sequence[str], salt: Column | str | None = None) -> DataFrame:
    """All rows of keys that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("entries")).where("entries > 1").select(*keys)
    return key_join(df, repeated, keys, "left_semi", salt)


def unit_price(receipts: Column, issues: Column) -> Column:
    """Average price in pence of receipts in pounds."""
    return F.try_divide(receipts * 100, issues)


def prices_by_period(sales: DataFrame, keys: Sequence[str], sources: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Several average prices per key, all in one pass over the sales.

    `sources` maps the name of a price column to its receipts and issues, each null on rows that do
    not count for it.
    """
    sums = []
    for name, (receipts, issues) in sources.items():
        sums += [F.sum(receipts).alias(f"_{name}_receipts"), F.sum(issues).alias(f"_{name}_issues")]
    prices = [
        unit_price(F.col(f"_{name}_receipts").cast("double"), F.col(f"_{name}_issues").cast("double")).alias(name)
        for name in sources
    ]
    return with_keys(sales, keys).groupBy(*keys).agg(*sums).select(*keys, *prices)


def combine_price_tables(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All price tables side by side, one row per key and combination of its entries.

    Joining the result once gives the same rows as joining the tables one after the other, and the
    large sales table moves once and not once per price table. Rows without a full key could match
    no sale and are left out. Price columns have different names in all tables.

    The tables are one union, grouped once: a key that no table lists twice comes out of the sums with all its
    prices. Only keys with several entries in some table, which the sums count, go through full outer joins
    that multiply them; without such keys there is no join at all.
    """
    tables = [with_keys(t, keys) for t in tables]
    names = [c for t in tables for c in t.columns if c not in keys]
    if len(set(names)) < len(names):
        raise ValueError(f"price columns of two tables have one name: {names}")
    tagged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("_table", F.lit(i)) for i, t in enumerate(tables)]
    )
    entries = [F.count_if(F.col("_table") == i) for i in range(len(tables))]
    sums = tagged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names], F.greatest(*entries, F.lit(0)).alias("_entries"))
    summed = stage(sums)
    once = summed.where("_entries = 1").select(*keys, *names)
    if summed.where("_entries > 1").isEmpty():
        return once
    several = stage(summed.where("_entries > 1").select(*keys))
    listed = [key_join(t, several, keys, "left_semi") for t in tables]
    return once.unionByName(reduce(lambda a, b: full_join(a, b, keys), listed))


def attach_prices(df: DataFrame, prices: DataFrame, keys: Sequence[str], salt: Column | str | None = None) -> DataFrame:
    return key_join(df, prices, keys, "left", salt)


def fill_gaps(df: DataFrame, preferred: str, fallback: str, target: str) -> DataFrame:
    """List price where there is one, else the derived price. A list price of zero counts as given."""
    return df.withColumn(target, F.coalesce(preferred, fallback))


def drop_unpriced(df: DataFrame, base: str, current: str) -> DataFrame:
    """Drop rows where either price is missing, not finite, or zero."""
    def usable(c: str) -> Column:
        price = F.col(c).cast("double")
        return null_if_zero(F.when(~F.isnan(price) & (F.abs(price) != F.lit(float("inf"))), price))

    return df.withColumns({base: usable(base), current: usable(current)}).dropna("any", subset=[base, current])


def with_change(df: DataFrame, base: str, current: str, target: str = "change") -> DataFrame:
    return df.withColumn(target, pct_change(current, base))


def _by_weight(df: DataFrame, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("weight"), *ties)


def large_rises(df: DataFrame, weight_limit: float, limit: float = 20.0, ties: Sequence[str] = ()) -> DataFrame:
    """Rises above the limit on rows below the weight limit.

    Review tables are sorted by weight. `ties` orders rows of equal weight; with a row position there,
    a weight that very many rows share is sorted in more than one task.
    """
    return _by_weight(df.where((F.col("change") > limit) & (F.col("weight") < weight_limit)), ties)


def large_falls(df: DataFrame, weight_limit: float, limit: float = 20.0, ties: Sequence[str] = ()) -> DataFrame:
    """Falls beyond the limit on rows below the weight limit."""
    return _by_weight(df.where((F.col("change") < -limit) & (F.col("weight") < weight_limit)), ties)


def heavy_rows(df: DataFrame, weight_limit: float, ties: Sequence[str] = ()) -> DataFrame:
    """Rows above the weight limit; taken before unpriced rows are dropped."""
    return _by_weight(df.where(F.col("weight") > weight_limit), ties)
