"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexloom.session import stage


def components(edges: DataFrame) -> DataFrame:
    """Component of each node of `edges` (columns a, b): columns node, component.

    A component is named by its smallest node. Loops, repeated edges and either direction are
    allowed, rows with a null end are left out, and no edges give no rows. Each step links every
    node to the smallest of its neighbours, so edges never grow in number and a hub only adds rows
    to partial minimums and to a join whose hot side adaptive execution can split. The steps needed
    grow with the logarithm of the longest path; each is cut off by a written table.
    """
    linked = stage(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    mark = _mark(linked)
    while True:
        linked = stage(_small_star(_large_star(linked)))
        before, mark = mark, _mark(linked)
        if before == mark:
            break
    stars = linked.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(linked.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(linked: DataFrame) -> tuple:
    """A fingerprint of the edge set, to see when it stops changing."""
    return tuple(linked.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(linked: DataFrame) -> DataFrame:
    """Links the larger neighbours of every node to the smallest of its neighbours and itself."""
    both = linked.unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(linked: DataFrame) -> DataFrame:
    """Links every node and its smaller neighbours to the smallest of them."""
    least = linked.groupBy("u").agg(F.min("v").alias("m"))
    moved = linked.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
