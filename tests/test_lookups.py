import pytest

from indexloom.operators import lookups
from indexloom.plans import fixed_values as fixed
from indexloom.plans import ingest


@pytest.mark.parametrize("carrier, sector", [("EK", "Lon SE"), ("EC", "Long D"), ("EA", "Regional"), ("??", "Missing"), (None, "Missing")])
def test_sector(spark, carrier, sector):
    df = spark.createDataFrame([(carrier,)], "carrier string")
    assert lookups.map_codes(df, fixed.SECTOR_BY_CARRIER, "carrier", "sector").first().sector == sector


def test_classify(spark):
    df = spark.createDataFrame([("EK", "9ABC", "PG04"), ("HM", "1ABC", "PG99"), ("HM", "3ABC", "PG01")], "carrier string, product string, product_group string")
    rows = ingest.classify(df, ingest.Codes()).collect()
    assert [(r["class"], r.ticket_type) for r in rows] == [("2", "Season"), ("1", "Other"), ("2", "Full")]


@pytest.mark.parametrize(
    "product, klass, carrier, flag2, audit, status",
    [
        ("2MTA", "2", "HM", None, "Unregulated_by_PCC", "Unregulated"),
        ("2MTA", "2", "EK", None, "Regulated_by_Product", "Regulated"),
        ("2BDY", "2", "EK", "SWT", "Unregulated_by_Product", "Unregulated"),
        ("2ZZZ", "2", "EK", "SWT", "Regulated_by_TOC", "Regulated"),
        ("2ZZZ", "2", "EK", "???", "Not Assigned", "Unregulated"),
        ("1MTA", "1", "EK", "SWT", "Unregulated_by_Class", "Unregulated"),
    ],
)
def test_status_cascade(spark, product, klass, carrier, flag2, audit, status):
    df = spark.createDataFrame([(product, klass, carrier, flag2)], "product string, class string, carrier string, flag2 string")
    row = lookups.status_cascade(df, fixed.STATUS_RULES, fixed.STATUS_COLLAPSE, fixed.STATUS_START).first()
    assert (row.status_pcc, row.status) == (audit, status)
    assert row.status_start == "Not Assigned"


def test_fixed_value_counts():
    assert (len(fixed.SECTOR_BY_CARRIER), len(fixed.REGULATED_PRODUCTS), len(set(fixed.REGULATED_CARRIERS))) == (26, 36, 47)


def test_missing_reports(spark):
    df = spark.createDataFrame([("Missing", "a"), ("Lon SE", "Missing"), ("Missing", "b")], "sector string, category string")
    assert lookups.missing_rows(df, "sector").count() == 2
    assert tuple(lookups.missing_counts(df, ["sector", "category"]).first()) == (2, 1)


def test_category_and_unmatched(spark):
    df = spark.createDataFrame([("a", "g"), ("b", "g"), ("b", "g")], "product string, product_group string")
    lookup = spark.createDataFrame([("a", "g", "Season")], "product string, product_group string, category string")
    on = ["product", "product_group"]
    assert sorted(r.category for r in lookups.category_lookup(df, lookup, on).collect()) == ["Missing", "Missing", "season"]
    assert [tuple(r) for r in lookups.unmatched_keys(df, lookup, on).collect()] == [("b", "g")]


def test_duplicate_lookup_keys_fan_out_and_are_reported(spark):
    df = spark.createDataFrame([("o", "d", "r", "p")], "origin string, destination string, route string, product string")
    lookup = spark.createDataFrame([("o", "d", "r", "p", "X"), ("o", "d", "r", "p", "Y")], "origin string, destination string, route string, product string, flag2 string")
    assert lookups.regulated_lookup(df, lookup, ingest.PRODUCT_KEY, ["flag2"]).count() == 2
    assert lookups.duplicate_keys(lookup, ingest.PRODUCT_KEY).first().entries == 2


def test_only_in_either_version(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    old = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert [tuple(r) for r in lookups.only_in(new, old, ["k"]).collect()] == [("a", 1)]
    assert [tuple(r) for r in lookups.only_in(old, new, ["k"]).collect()] == [("c", 3)]
