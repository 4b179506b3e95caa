import pytest

from indexloom.operators import usage

ROWS = "sector string, q int, value double"


def series(spark, values):
    return spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], ROWS)


def column(df, name):
    return [r[name] for r in df.orderBy("q").collect()]


def test_trailing_sum(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0, None, 6.0, 7.0, 8.0, 9.0])
    got = column(usage.trailing_sum(df, "value", "year", ["sector"], ["q"]), "year")
    assert got == [None, None, None, 10.0, None, None, None, None, 30.0]


def test_change_fills_gaps_first(spark):
    got = column(usage.change_on_previous(series(spark, [1.0, None, 2.0]), "value", "change", ["sector"], ["q"]), "change")
    assert got == [None, 0.0, 100.0]


def test_chained_index(spark):
    got = column(usage.chained_index(series(spark, [2.0, None, -1.0]), "value", "index", ["sector"], ["q"]), "index")
    assert got == [pytest.approx(102.0), None, pytest.approx(100.98)]


def test_total_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    assert [r.t for r in usage.with_total(df, ["a", "b"], "t").collect()] == [3.0, None]


def test_rollup_filters(spark):
    rows = [
        (2002, "2002-03 Quarter 1", 1, "Approved", 1.0),
        (2002, "2002-03 Quarter 1", 1, "published", 2.0),
        (2002, "2002-03 Quarter 1", 9, "published", 4.0),
        (2002, "2002-03 Quarter 1", 1, "draft", 8.0),
        (2001, "2001-02 Quarter 4", 1, "published", 16.0),
        (2002, "2002-03 Quarter 2", None, "published", 32.0),
    ]
    df = spark.createDataFrame(rows, "financial_year_key int, year_and_quarter string, source_item_id int, publication_status string, x double")
    got = usage.usage_rollup(df, ["x"], 9, "2002-03 Quarter 1").collect()
    assert [tuple(r) for r in got] == [(2002, "2002-03 Quarter 1", 3.0)]
    only = usage.usage_rollup(df, ["x"], 9, "2002-03 Quarter 1", ["draft"]).collect()
    assert [r.x for r in only] == [8.0]


def test_revenue_per_journey(spark):
    rows = []
    for year in (2002, 2003, 2004):
        for q in (1, 2, 3, 4):
            for sector, growth in (("a", 1.1), ("b", 1.0)):
                label = f"{year}-{(year + 1) % 100:02d} Quarter {q}"
                rows.append((year, label, sector, 100.0 * growth ** (year - 2002), 10.0))
    df = spark.createDataFrame(rows, "financial_year_key int, year_and_quarter string, sector string, revenue double, journeys double")
    got = {(r.sector, r.label): r.value for r in usage.revenue_per_journey_change(df, {"a": "A", "b": "B"}).collect()}
    # Trailing years end in quarter 3, so the first complete one is 2003-04 and the first change that of 2004-05.
    assert got == {("A", "January 2005"): pytest.approx(10.0), ("B", "January 2005"): pytest.approx(0.0)}
