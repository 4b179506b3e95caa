import math
import random
from decimal import Decimal

import pytest


from indexloom.functions import stable_sum
from indexloom.operators import index, rollups

CELL = "sector string, class string, category string, status string"


def grid_of(spark, priced, weights):
    p = spark.createDataFrame([("S", "1", c, "Regulated", Decimal(w), x) for c, w, x in priced], f"{CELL}, weight decimal(18,4), change double")
    w = spark.createDataFrame([("S", "1", c, "Regulated", None if x is None else Decimal(x)) for c, x in weights], f"{CELL}, weight decimal(18,4)")
    return index.cell_grid(p, w)


def test_weighted_change(spark):
    row = grid_of(spark, [("a", 100, 10.0), ("a", 300, -2.0)], [("a", 1000)]).first()
    assert row.weighted_change == pytest.approx(1.0)
    assert row.contribution == pytest.approx(1000.0)


def test_cells_of_one_side_stay_and_zero_weight_goes(spark):
    grid = grid_of(spark, [("priced only", 10, 1.0), ("zero", 10, 1.0)], [("weight only", 5), ("zero", 0)])
    found = {r.category: (r.priced_weight, r.total_weight, r.weighted_change) for r in grid.collect()}
    assert found == {"priced only": (10, None, 1.0), "weight only": (None, 5, None)}


def test_cell_without_change_adds_weight_only(spark):
    grid = grid_of(spark, [("a", 1, 2.0)], [("a", 50), ("b", 50)])
    report = {r.split: r for r in index.split_report(grid).collect() if r.split == "class"}
    assert report["class"].average_change == pytest.approx(1.0)
    assert report["class"].total_weight == 100


def test_null_keys_do_not_count(spark):
    df = spark.createDataFrame([(None, Decimal(5)), ("a", Decimal(1)), ("a", None)], "k string, w decimal(18,4)")
    assert [tuple(r) for r in rollups.sum_by(df, ["k"], ["w"]).collect()] == [("a", 1)]


def test_sum_over_nulls_is_zero(spark):
    df = spark.createDataFrame([("a", None)], "k string, w double")
    assert rollups.sum_by(df, ["k"], ["w"]).first().w == 0


def full_grid(spark):
    rows = [
        (s, c, k, r, 10.0 * i + 5, Decimal(10 * i + 7), float(i % 5 - 2), None)
        for i, (s, c, k, r) in enumerate((s, c, k, r) for s in "XYZ" for c in "12" for k in ("advance", "season") for r in ("Regulated", "Unregulated"))
    ]
    grid = spark.createDataFrame(rows, f"{CELL}, priced_weight double, total_weight decimal(18,4), weighted_change double, contribution double")
    return grid.withColumn("contribution", grid.weighted_change * grid.total_weight.cast("double"))


def test_split_invariants(spark):
    grid = full_grid(spark)
    rows = index.split_report(grid).collect()
    cells = grid.collect()
    total = sum(r.total_weight for r in cells)
    mean = sum(r.contribution for r in cells) / float(total)
    assert {r.split for r in rows} == {name for name, _ in index.SPLITS}
    for name, _ in index.SPLITS:
        part = [r for r in rows if r.split == name]
        assert sum(r.total_weight for r in part) == total
        assert sum(r.share for r in part) == pytest.approx(1.0)
        assert sum(r.average_change * float(r.total_weight) for r in part) / float(total) == pytest.approx(mean)


def test_part_labels(spark):
    rows = index.split_report(full_grid(spark)).collect()
    assert {r.part for r in rows if r.split == "sector2"} == {"X", "Y", "Z"}
    assert "('X', '1')" in {r.part for r in rows if r.split == "sector and class"}
    assert "('X', '1', 'Regulated')" in {r.part for r in rows if r.split == "sector, class and regulation"}


def test_shares(spark):
    grid = grid_of(spark, [("a", 1, 2.0)], [("a", 30), ("b", 70)])
    assert sorted(r.share for r in index.split_by(grid, "category", ["category"]).collect()) == [0.3, 0.7]


def test_price_side(spark):
    schema = "origin string, destination string, product string, sector string, class string, weight double, change double"
    advance = spark.createDataFrame([("0001", "0002", "2AAA", "S", "1", 1.0, 5.0), ("0001", "0002", "2AAA", "S", "1", 1.0, 20.0)], schema)
    other = spark.createDataFrame(
        [("0001", "0002", "2MTC", "S", "1", "Regulated", "season", 2.0, 1.0), ("A001", "0002", "2AAA", "S", "1", "Regulated", "season", 3.0, 1.0),
         ("0001", "0002", "2AAA", "S", "2", "Regulated", "season", 4.0, -19.9), ("0001", "0002", "2AAA", "S", "2", "Regulated", "season", 4.0, -20.0)],
        "origin string, destination string, product string, sector string, class string, status string, category string, weight double, change double",
    )
    rows = {tuple(r) for r in index.price_side(advance, other, ["2MTC"]).collect()}
    assert rows == {("S", "1", "advance", "Unregulated", 1.0, 5.0), ("S", "2", "season", "Regulated", 4.0, -19.9)}


def test_rows_without_a_product_stay(spark):
    df = spark.createDataFrame([("1ADV",), (None,), ("2MTA",)], "product string")
    assert [r[0] for r in index.without_products(df, ["1ADV"]).collect()] == [None, "2MTA"]


def test_sums_do_not_depend_on_partitions(spark):
    """Weights and changes of very different sizes: the grid and its report are the same to the last bit."""
    rng = random.Random(8)
    cells = [(s, c, "anytime", "Regulated") for s in ("Long D", "Regional") for c in "12"]
    rows = [(*rng.choice(cells), Decimal(rng.randrange(10**12)).scaleb(-2), rng.choice([1e-9, 1e-3, 1.0, 19.0]) * rng.uniform(-1, 1)) for _ in range(3000)]
    schema = "sector string, class string, category string, status string, weight decimal(18,2), change double"
    seen = set()
    for n in (1, 7, 200):
        priced = spark.createDataFrame(rows, schema).repartition(n)
        grid = index.cell_grid(priced, priced.select(*index.CELL, "weight"))
        told = sorted(map(tuple, grid.select(*index.CELL, "weighted_change", "contribution").collect()))
        report = sorted((r.split, r.part, r.average_change) for r in index.split_report(grid).collect())
        seen.add((tuple(told), tuple(report)))
        rng.shuffle(rows)
    assert len(seen) == 1
    exact = {c: math.fsum(float(r[4]) * r[5] for r in rows if r[:4] == c) / float(sum(r[4] for r in rows if r[:4] == c)) for c in cells}
    assert {t[:4]: pytest.approx(t[4], rel=1e-12) for t in told} == exact


def test_stable_sum(spark):
    df = spark.createDataFrame([(1, 0.1), (1, -0.3), (1, 1e17), (1, -1e17), (1, None), (2, None), (3, float("nan")), (4, 1e300), (4, 1.0), (5, -2.5), (5, 2.0**-47)], "k int, v double")
    found = {r.k: r.s for r in df.groupBy("k").agg(stable_sum("v").alias("s")).collect()}
    assert found[1] == pytest.approx(-0.2, abs=1e-14) and found[2] is None and math.isnan(found[3])
    assert found[4] == 1e300 and found[5] == -2.5 + 2.0**-47
