import pytest
from pyspark.sql import functions as F

from indexloom.operators import series
from indexloom.plans import publish

COLUMNS = (
    "load_id int, publication_status string, sector string, ticket_category string, category_order int, "
    "label string, label_order int, value double"
)
SECTORS = {"London and South East": 200.0, "Long distance": 300.0, "Regional": 100.0}


def block(sector, ticket_category, order, values, statistics, tail=0.0):
    years = [(f"January {y}", y - 2000, v) for y, v in sorted(values.items())]
    stats = [(label, 100 + i, tail) for i, label in enumerate(statistics)]
    return [(5, "Approved", sector, ticket_category, order, *row) for row in [*years, *stats]]


def sector_series(spark):
    statistics = series.BY_SECTOR.statistics(0)
    rows = []
    for sector, value in SECTORS.items():
        rows += block(sector, "All tickets", 1, {2017: value - 1, 2018: value}, statistics)
    rows += block("All operators", "All tickets", 1, {2017: 199.0, 2018: 200.0}, statistics)
    rows += block("Regional", "Revenue per journey", 2, {2016: 100.0, 2017: 101.0, 2018: 102.0}, statistics[:1])
    rows += block("RPI", "All items index", 9, {2017: 150.0, 2018: 160.0}, statistics[:1])
    return spark.createDataFrame(rows, COLUMNS)


REPORT = "sector string, ticket_category string, average_change double, total_weight double, share double"


def report(spark, missing=()):
    rows = [
        ("London and South East", "All tickets", 3.0, 100.0, 0.5),
        ("Long distance", "All tickets", 1.0, 60.0, 0.3),
        ("Regional", "All tickets", 2.0, 40.0, 0.2),
    ]
    return spark.createDataFrame([r for r in rows if r[0] not in missing], REPORT)


def value(df, sector, label, ticket_category="All tickets"):
    found = df.where((F.col("sector") == sector) & (F.col("label") == label) & (F.col("ticket_category") == ticket_category)).collect()
    assert len(found) == 1
    return found[0].value


def test_extend(spark):
    df = series.extend_series(sector_series(spark), series.BY_SECTOR)
    assert {(r.load_id, r.publication_status) for r in df.collect()} == {(6, "Approved")}
    rows = [(r.label, r.label_order, r.value) for r in df.where("sector = 'Long distance'").collect()]
    assert rows == [
        ("January 2017", 17, 299.0), ("January 2018", 18, 300.0), ("January 2019", 19, None),
        (series.AVERAGE_CHANGE, 20, None), (series.WEIGHT_SHARE, 21, None),
        (series.REAL_YEAR_ON_YEAR, 22, None), (series.REAL_SINCE_2004, 23, None),
    ]


def test_extend_moves_the_years_in_labels(spark):
    statistics = series.BY_TICKET_TYPE.statistics(2018)
    assert statistics[2] == "Real terms change in average price 2018 on 2017"
    df = spark.createDataFrame(block("Regional operators", "All tickets", 1, {2017: 1.0, 2018: 2.0}, statistics), COLUMNS)
    labels = [r.label for r in series.extend_series(df, series.BY_TICKET_TYPE).collect()]
    assert labels[-2:] == ["Real terms change in average price 2019 on 2018", "Real terms change in average price 2019 on 1995"]


def test_fill(spark):
    template = series.extend_series(sector_series(spark), series.BY_SECTOR)
    df = series.fill_series(template, report(spark), series.BY_SECTOR, 2.5, 2019)
    assert value(df, "London and South East", "January 2018") == 200.0
    assert value(df, "London and South East", "January 2019") == pytest.approx(206.0)
    assert value(df, "London and South East", series.AVERAGE_CHANGE) == 3.0
    assert value(df, "London and South East", series.WEIGHT_SHARE) == pytest.approx(50.0)
    assert value(df, "London and South East", series.REAL_YEAR_ON_YEAR) == pytest.approx(0.4878, abs=1e-4)
    # The deflator moves from 160 to 164.
    assert value(df, "RPI", "January 2019", "All items index") == pytest.approx(164.0)
    assert value(df, "RPI", series.AVERAGE_CHANGE, "All items index") == 2.5
    assert value(df, "London and South East", series.REAL_SINCE_2004) == pytest.approx((206 - 164) / 164 * 100)
    change = (3 * 100 + 1 * 60 + 2 * 40) / 200
    assert value(df, "All operators", series.AVERAGE_CHANGE) == pytest.approx(change)
    assert value(df, "All operators", series.WEIGHT_SHARE) == 100.0
    assert value(df, "All operators", "January 2019") == pytest.approx(200 * (1 + change / 100))


def test_wrong_year_is_refused(spark):
    template = series.extend_series(sector_series(spark), series.BY_SECTOR)
    with pytest.raises(ValueError):
        series.fill_series(template, report(spark), series.BY_SECTOR, 2.5, 2020)


def test_total_needs_all_three_sectors(spark):
    assert series.all_sector_change(report(spark), series.BY_SECTOR.sectors).first().average_change == pytest.approx(2.2)
    assert series.all_sector_change(report(spark, missing=["Regional"]), series.BY_SECTOR.sectors).first().average_change is None


def test_report_keys_drop_doubles(spark):
    found = spark.createDataFrame([("sector1", "Regional", 1.0, 2.0, 0.1), ("sector2", "Regional", 1.0, 2.0, 0.1)], "split string, part string, average_change double, total_weight double, share double")
    keys = spark.createDataFrame([("Regional", "Regional", "All tickets")], "part string, sector string, ticket_category string")
    assert series.report_for_series(found, keys).count() == 1


def test_revenue_per_journey(spark):
    template = series.extend_series(sector_series(spark), series.BY_SECTOR)
    changes = spark.createDataFrame(
        [("Regional", "January 2017", 2.0), ("Regional", "January 2018", -1.0), ("Regional", "January 2019", 5.0)],
        "sector string, label string, value double",
    )
    df = series.insert_revenue_per_journey(template, changes)
    name = series.REVENUE_PER_JOURNEY
    assert value(df, "Regional", "January 2016", name) == 100.0
    assert value(df, "Regional", "January 2017", name) == pytest.approx(102.0)
    assert value(df, "Regional", "January 2018", name) == pytest.approx(100.98)
    assert value(df, "Regional", "January 2019", name) == pytest.approx(100.98 * 1.05)
    assert value(df, "Regional", series.AVERAGE_CHANGE, name) == 5.0
    assert value(df, "Regional", "January 2018") == 100.0
    variance = df.where("ticket_category = 'Revenue per journey' and label = 'January 2018'").first().variance
    assert variance == pytest.approx(102.0 - 100.98)


def test_next_series(spark):
    found = spark.createDataFrame(
        [("sector1", "Lon SE", 3.0, 100.0, 0.5), ("sector1", "Long D", 1.0, 60.0, 0.3), ("sector1", "Regional", 2.0, 40.0, 0.2)],
        "split string, part string, average_change double, total_weight double, share double",
    )
    keys = spark.createDataFrame(
        [("Lon SE", "London and South East", "All tickets"), ("Long D", "Long distance", "All tickets"), ("Regional", "Regional", "All tickets")],
        "part string, sector string, ticket_category string",
    )
    df = publish.next_series(sector_series(spark), found, keys, series.BY_SECTOR, 2.5)
    assert value(df, "Regional", "January 2019") == pytest.approx(102.0)


def test_latest_value(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0)], "k string, o int, v double")
    assert series.latest_value(df, ["k"], "v", "o").first().v == 6.0


def test_kinds():
    assert series.series_kind("ticket_type") is series.BY_TICKET_TYPE
    with pytest.raises(ValueError):
        series.series_kind("other")
