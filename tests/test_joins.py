"""The join has to give the same rows whatever path it takes."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indexloom.operators import colocated, joins
from indexloom.operators.joins import full_join, hot_keys, key_bitmaps, key_join, sparse_join, with_possible_match


def brute_force(left, right, how):
    out = []
    for a, row in left:
        hits = [v for k, v in right if a is not None and k == a]
        if how == "left_semi":
            out += [(a, row)] if hits else []
        elif how == "left_anti":
            out += [] if hits else [(a, row)]
        else:
            out += [(a, row, v) for v in hits]
            if how == "left" and not hits:
                out.append((a, row, None))
    return Counter(out)


def frames(spark, left, right):
    return spark.createDataFrame(left, "k string, row long"), spark.createDataFrame(right, "k string, v long")


def skewed():
    """A third of the rows on one key, a third without key, the rest spread, and copies of one row."""
    rows = [("hot", i % 7) for i in range(400)] + [(None, i) for i in range(400)]
    rows += [(f"k{i % 90}", i) for i in range(300)] + [("copy", 1)] * 100
    return rows


LOOKUP = [("hot", 1), ("hot", 2), ("copy", 3), (None, 4)] + [(f"k{i}", i) for i in range(0, 90, 2)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("salted", [True, False])
def test_same_rows_on_every_path(spark, how, broadcast, salted):
    left, right = frames(spark, skewed(), LOOKUP)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100MB" if broadcast else "-1")
    try:
        found = key_join(left, right, ["k"], how, "row" if salted else None)
        assert found.columns == (["k", "row"] if how in ("left_semi", "left_anti") else ["k", "row", "v"])
        assert Counter(map(tuple, found.collect())) == brute_force(skewed(), LOOKUP, how)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), min_size=1, max_size=40),
    right=st.lists(st.tuples(st.sampled_from(["a", "b", "d", None]), st.integers(0, 3)), max_size=8),
    how=st.sampled_from(["left", "inner", "left_semi", "left_anti"]),
)
def test_matches_brute_force(without_broadcast, left, right, how):
    l, r = frames(without_broadcast, left, right)
    assert Counter(map(tuple, key_join(l, r, ["k"], how).collect())) == brute_force(left, right, how)


def test_hot_rows_are_spread(without_broadcast):
    """No shuffle partition of the join may see most of a hot key."""
    rows = [("hot", i) for i in range(8000)] + [(f"k{i}", i) for i in range(2000)]
    left, right = frames(without_broadcast, rows, [("hot", 1)] + [(f"k{i}", i) for i in range(2000)])
    found = {r.k: r["__pieces"] for r in hot_keys(left, ["k"])}
    assert found == {"hot": 7}
    without_broadcast.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = key_join(left, right, ["k"], "left", "row").withColumn("p", F.spark_partition_id())
        largest = joined.where("k = 'hot'").groupBy("p").count().agg(F.max("count")).first()[0]
    finally:
        without_broadcast.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest < 8000 * 0.6


def test_hot_keys_are_few(spark):
    rows = [(f"k{i % 50}", i) for i in range(5000)]
    assert hot_keys(spark.createDataFrame(rows, "k string, row long"), ["k"]) == []


def test_unknown_join_kind(spark):
    left, right = frames(spark, [("a", 1)], [("a", 1)])
    with pytest.raises(ValueError):
        key_join(left, right, ["k"], "full")


def test_full_join_of_hot_keys(without_broadcast):
    """Both sides have a key with a third of their rows, keys of their own, exact copies and null keys."""
    spark = without_broadcast
    left = [(1, i % 3) for i in range(40)] + [(k, k) for k in range(2, 60)] + [(None, 7), (None, 7)]
    right = [(1, i) for i in range(30)] + [(k, k) for k in range(40, 90)] + [(None, 8)]
    a, b = spark.createDataFrame(left, "k int, x int"), spark.createDataFrame(right, "k int, y int")
    expected = Counter(map(tuple, a.join(b, ["k"], "full").collect()))
    assert Counter(map(tuple, full_join(a, b, ["k"]).collect())) == expected


def test_sparse_join_equals_a_left_join(without_broadcast):
    """Keys of two columns, null in either, hot, listed twice, and in few rows only."""
    spark = without_broadcast
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 <> 1 THEN id END AS a", "CASE WHEN id % 13 <> 5 THEN cast(id % 5 AS string) END AS b", "id AS row")
    right = spark.createDataFrame([(7, "1", "x"), (7, "1", "y"), (10, "0", "z"), (None, "1", "n"), (9999, "4", "far"), (20, None, "n")], "a long, b string, c string")
    expected = left.join(right, ["a", "b"], "left")
    found = sparse_join(left, right, ["a", "b"], "row")
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    nothing = sparse_join(left, right.limit(0), ["a", "b"], "row")
    assert Counter(map(tuple, nothing.collect())) == Counter((*r, None) for r in left.select("a", "b", "row").collect())


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_bitmaps_rule_out_no_match(spark, bits):
    keys = spark.range(0, 4000, 5).withColumnRenamed("id", "k")
    bitmaps = key_bitmaps(keys, ["k"], bits)
    told = with_possible_match(spark.range(4000).withColumnRenamed("id", "k"), bitmaps, ["k"], bits).collect()
    assert all(r["__may"] for r in told if r.k % 5 == 0)
    assert sum(r["__may"] for r in told) <= 800 * (1.01 if bits > 1 << 15 else 1.2)
    assert bitmaps.count() <= bits >> 15


def test_colocated_joins_shuffle_nothing(without_broadcast):
    """Two lookups attached to a bucketed table with a hot key, null keys and repeated entries: no exchange, and the same rows."""
    spark = without_broadcast
    large = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 17 <> 5 THEN id % 90 END AS k", "CASE WHEN id % 3 = 0 THEN '3' ELSE cast(id % 4 AS string) END AS p", "id AS row")
    one = spark.range(100).selectExpr("id AS k", "cast(id % 4 AS string) AS p", "id * 2 AS x").unionByName(spark.createDataFrame([(7, "3", -1), (None, "1", 0)], "k long, p string, x long"))
    two = spark.range(0, 100, 2).selectExpr("id AS k", "cast(id % 4 AS string) AS p", "id * 3 AS y")
    to = colocated.layout(large, ["k", "p"], 4)
    assert any(r["k"] == 7 for r in to.hot) and len(to.hot) <= 8
    found = colocated.attach(colocated.attach(colocated.write_large(large, to, "row"), colocated.write_entries(one, to), to), colocated.write_entries(two, to), to)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Bucketed: true" in plan
    expected = large.join(one, ["k", "p"], "left").join(two, ["k", "p"], "left")
    assert Counter(map(tuple, found.select(expected.columns).collect())) == Counter(map(tuple, expected.collect()))
    largest = max(r["count"] for r in colocated.write_large(large, to, "row").groupBy("k", "p", colocated.PIECE).count().collect())
    assert largest < 4000 / 5
    with pytest.raises(ValueError):
        colocated.attach(large, one, to, "full")


def test_hot_keys_whatever_their_hashes(spark, monkeypatch):
    """Keys that share a hash are told apart, and without a full hash the keys themselves are not counted."""
    rows = [("a", 1)] * 500 + [(None, 1)] * 400 + [(f"k{i}", 1) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, n int")
    expected = {("a", 4), (None, 4)}
    for hashes in (1, 3, 1 << 16):
        monkeypatch.setattr(joins, "HASHES", hashes)
        assert {tuple(r) for r in joins.hot_keys(df, ["k"])} == expected
    assert joins.hot_keys(df.where("k like 'k%'"), ["k"]) == []
