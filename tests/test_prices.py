from collections import Counter

import pytest
from pyspark.sql import functions as F

from indexloom import session
from indexloom.operators import prices

FLOW = ["origin", "destination", "route"]


def test_latest_validity_keeps_ties(spark):
    rows = [("o", "d", "r", 2100, "a"), ("o", "d", "r", 2100, "b"), ("o", "d", "r", 2020, "c"), ("o", "x", "r", 1999, "d")]
    df = spark.createDataFrame(rows, "origin string, destination string, route string, until int, id string")
    assert {r.id for r in prices.latest_validity(df, FLOW, "until").collect()} == {"a", "b", "d"}


def test_latest_validity_on_the_shuffled_path(without_broadcast):
    rows = [("o", "d", "r", i % 10, i) for i in range(500)] + [("o", str(i), "r", i, i) for i in range(100)]
    df = without_broadcast.createDataFrame(rows, "origin string, destination string, route string, until int, id int")
    found = prices.latest_validity(df, FLOW, "until", "id").collect()
    assert len(found) == 50 + 100


def test_keep_first(spark):
    df = spark.createDataFrame([("k", 2, "B"), ("k", 1, "A"), ("m", 3, "C")], "key string, seq int, product string")
    assert {tuple(r) for r in prices.keep_first(df, ["key"], ["seq"]).collect()} == {("k", 1, "A"), ("m", 3, "C")}


def test_keep_first_with_a_null_key(spark):
    df = spark.createDataFrame([(None, 2, "B"), (None, 1, None)], "key string, seq int, product string")
    assert [tuple(r) for r in prices.keep_first(df, ["key"], ["seq"]).collect()] == [(None, 1, None)]


def test_keep_first_sums_by_hashing(spark):
    """Least positions and entry counts are kept in hash tables; only keys and numbers are summed."""
    df = spark.range(100).selectExpr("id % 7 AS key", "id", "cast(id AS decimal(38,0)) AS place", "cast(id AS string) AS text")
    for place in ("id", "place"):
        found = prices.keep_first(df, ["key"], [place])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
        assert sorted(r.text for r in found.collect()) == [str(i) for i in range(7)]
    assert {(r.key, r.first, r.entries) for r in prices.key_summary(df, ["key"], "id").collect()} == {(i, i, 15 if i < 2 else 14) for i in range(7)}


def test_conflicting_duplicates(spark):
    df = spark.createDataFrame([("k", 500), ("k", 520), ("m", 1)], "key string, fare int")
    assert {r.fare for r in prices.conflicting_duplicates(df, ["key"]).collect()} == {500, 520}


@pytest.mark.parametrize("listed, derived, filled", [(None, 90.0, 90.0), (0.0, 90.0, 0.0), (80.0, 90.0, 80.0), (None, None, None)])
def test_gap_fill(spark, listed, derived, filled):
    df = spark.createDataFrame([(listed, derived)], "listed double, derived double")
    assert prices.fill_gaps(df, "listed", "derived", "price").first().price == filled


def test_drop_unpriced(spark):
    rows = [(100.0, 110.0), (0.0, 110.0), (100.0, None), (100.0, float("nan")), (float("inf"), 1.0), (100.0, 0.0)]
    df = spark.createDataFrame(rows, "base double, current double")
    kept = prices.with_change(prices.drop_unpriced(df, "base", "current"), "base", "current").collect()
    assert [tuple(r) for r in kept] == [(100.0, 110.0, pytest.approx(10.0))]


def test_review_sets(spark):
    rows = [(25.0, 499_999.0), (25.0, 500_000.0), (5.0, 500_001.0), (-25.0, 1.0), (20.0, 1.0), (-20.0, 1.0)]
    df = spark.createDataFrame(rows, "change double, weight double")
    assert [tuple(r) for r in prices.large_rises(df, 500_000).collect()] == [(25.0, 499_999.0)]
    assert [tuple(r) for r in prices.large_falls(df, 500_000).collect()] == [(-25.0, 1.0)]
    assert [tuple(r) for r in prices.heavy_rows(df, 500_000).collect()] == [(5.0, 500_001.0)]


def test_review_sets_are_sorted_by_weight(spark):
    df = spark.createDataFrame([(30.0, 1.0, 1), (30.0, 3.0, 2), (30.0, 2.0, 3), (30.0, 3.0, 0)], "change double, weight double, row int")
    assert [r.row for r in prices.large_rises(df, 10, ties=["row"]).collect()] == [0, 2, 3, 1]


def test_one_combined_join_equals_a_chain_of_joins(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, id int")
    base = spark.createDataFrame([("a", 10.0), ("a", 11.0), ("b", 20.0), (None, 1.0)], "k string, base double")
    current = spark.createDataFrame([("a", 12.0), ("a", 13.0), ("d", 9.0), (None, 2.0)], "k string, current double")
    chain = fact.join(base, ["k"], "left").join(current, ["k"], "left")
    once = prices.attach_prices(fact, prices.combine_price_tables([base, current], ["k"]), ["k"])
    assert Counter(map(tuple, once.collect())) == Counter(map(tuple, chain.collect()))


def test_prices_by_period(spark):
    rows = [("a", 1, 10.0, 2.0), ("a", 1, 20.0, 4.0), ("a", 2, 9.0, 3.0), ("b", 2, 5.0, 0.0), (None, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, year int, receipts double, issues double")
    sources = {
        f"y{y}": (F.when(F.col("year") == y, F.col("receipts")), F.when(F.col("year") == y, F.col("issues"))) for y in (1, 2)
    }
    found = {r.k: (r.y1, r.y2) for r in prices.prices_by_period(df, ["k"], sources).collect()}
    assert found == {"a": (500.0, 300.0), "b": (None, None)}


def test_first_rows_are_fetched_in_more_tasks_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    df = session.stage(spark.range(5000).selectExpr("CAST(id % 1000 AS STRING) AS key", "id AS seq"))
    found = prices.keep_first(df, ["key"], ["seq"])
    assert found.rdd.getNumPartitions() == 50
    assert sorted((r.key, r.seq) for r in found.collect()) == sorted((str(i), i) for i in range(1000))
