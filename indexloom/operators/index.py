"""From priced detail rows to the cell grid and the split report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from indexloom.functions import has_code, stable_sum
from indexloom.operators.rollups import sum_by, with_keys

CELL = ["sector", "class", "category", "status"]
# The pattern of a place that is kept.
FOUR_DIGITS = "[0-9][0-9][0-9][0-9]"

# Report name and the cell keys it is split by; the sector split is published under two names.
SPLITS: list[tuple[str, list[str]]] = [
    ("sector1", ["sector"]),
    ("sector2", ["sector"]),
    ("class", ["class"]),
    ("sector and class", ["sector", "class"]),
    ("regulation", ["status"]),
    ("category", ["category"]),
    ("sector and category", ["sector", "category"]),
    ("sector, class and regulation", ["sector", "class", "status"]),
    ("class and regulation", ["class", "status"]),
]


def union_detail(advance: DataFrame, non_advance: DataFrame) -> DataFrame:
    """Both kinds of detail in one frame; advance rows carry no status or category of their own."""
    both = advance.unionByName(non_advance, allowMissingColumns=True)
    return both.withColumns(
        {
            "status": F.coalesce("status", F.lit("Unregulated")),
            "category": F.coalesce("category", F.lit("advance")),
        }
    )


def numeric_places(df: DataFrame) -> DataFrame:
    """Keep rows whose origin and destination both hold four digits in a row."""
    return df.where(has_code("origin", FOUR_DIGITS) & has_code("destination", FOUR_DIGITS))


def without_products(df: DataFrame, products: Sequence[str]) -> DataFrame:
    """Leave out the named products; rows without a product stay."""
    return df.where(F.col("product").isNull() | ~F.col("product").isin(list(products))) if products else df


def trim_outliers(df: DataFrame, limit: float = 20.0) -> DataFrame:
    """Keep changes strictly inside the limit on both sides."""
    return df.where((F.col("change") > -limit) & (F.col("change") < limit))


def price_side(advance: DataFrame, non_advance: DataFrame, excluded_products: Sequence[str]) -> DataFrame:
    """Detail rows that take part in the price change."""
    rows = without_products(numeric_places(union_detail(advance, non_advance)), excluded_products)
    return trim_outliers(rows).select(*CELL, "weight", "change")


def cell_grid(priced: DataFrame, fact_weights: DataFrame) -> DataFrame:
    """Weighted change per cell next to the full weight of the cell.

    Cells known to one side only are kept, with null for what the other side would give. Both sides
    go through one grouped sum, which replaces a full outer join of two grouped results. The sum of the
    double factors is a `stable_sum`, so the grid is the same however the rows are partitioned.
    """
    price_rows = with_keys(priced, CELL).select(
        *CELL,
        F.col("weight").alias("priced_weight"),
        (F.col("weight").cast("double") * F.col("change")).alias("factor"),
    )
    weight_rows = with_keys(fact_weights, CELL).select(*CELL, F.col("weight").alias("total_weight"))
    grid = (
        price_rows.unionByName(weight_rows, allowMissingColumns=True)
        .groupBy(*CELL)
        .agg(
            stable_sum("factor").alias("factor"),
            F.sum("priced_weight").alias("priced_weight"),
            F.sum("total_weight").alias("total_weight"),
        )
    )
    change = F.try_divide("factor", F.col("priced_weight").cast("double"))
    return (
        grid.where(F.col("total_weight").isNull() | (F.col("total_weight") != 0))
        .withColumn("weighted_change", change)
        .withColumn("contribution", change * F.col("total_weight").cast("double"))
        .drop("factor")
    )


def part_label(keys: Sequence[str]) -> Column:
    """Name of a part: the key itself, or several keys as in `('Long D', '1')`."""
    if len(keys) == 1:
        return F.col(keys[0])
    quoted = [F.concat(F.lit("'"), F.col(k), F.lit("'")) for k in keys]
    return F.concat(F.lit("("), F.concat_ws(", ", *quoted), F.lit(")"))


def split_report(grid: DataFrame, splits: Sequence[tuple[str, list[str]]] = SPLITS) -> DataFrame:
    """Change, weight and share of weight for every part of every split.

    All splits come from one pass over the grid with grouping sets. A cell without a change adds
    its weight but no contribution.
    """
    names_by_keys: dict[tuple[str, ...], list[str]] = {}
    for name, keys in splits:
        names_by_keys.setdefault(tuple(keys), []).append(name)

    sums = grid.groupingSets([list(k) for k in names_by_keys], *CELL).agg(
        F.grouping_id(*CELL).alias("_gid"),
        F.coalesce(stable_sum("contribution"), F.lit(0.0)).alias("_contribution"),
        F.sum("total_weight").alias("total_weight"),
    )
    names = F.lit(None).cast("array<string>")
    label = F.lit(None).cast("string")
    for keys, split_names in names_by_keys.items():
        gid = sum(0 if c in keys else 1 << (len(CELL) - 1 - i) for i, c in enumerate(CELL))
        is_split = F.col("_gid") == gid
        names = F.when(is_split, F.array(*[F.lit(n) for n in split_names])).otherwise(names)
        label = F.when(is_split, part_label(keys)).otherwise(label)
    return (
        sums.withColumn("part", label)
        .withColumn("split", F.explode(names))
        .withColumn("average_change", F.try_divide("_contribution", F.col("total_weight").cast("double")))
        .withColumn("share", weight_share("total_weight", "split"))
        .select("split", "part", *CELL, "average_change", "total_weight", "share")
    )


def weight_share(weight: str, split: str) -> Column:
    """Share of a part in the weight of its split; the report has a handful of rows per split."""
    return F.try_divide(F.col(weight).cast("double"), F.sum(weight).over(W.partitionBy(split)).cast("double"))


def split_by(grid: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One split on its own, with only its own key columns."""
    report = split_report(grid, [(name, list(keys))])
    return report.select("split", "part", *keys, "average_change", "total_weight", "share")


def prepared_weights(fact: DataFrame) -> DataFrame:
    """Weight side of the grid: rows without a product key do not count."""
    return sum_by(with_keys(fact, ["product", "product_group"]), CELL, ["weight"])
