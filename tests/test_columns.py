from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from indexloom import functions as fn


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("r")).first().r


def test_money_is_exact(spark):
    assert one(spark, fn.clean_money("c"), c=("string", "£1,234.50")) == Decimal("1234.5")


def test_bad_money_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.clean_money("c"), c=("string", "abc"))


def test_missing_money_is_null(spark):
    assert one(spark, fn.clean_money("c"), c=("string", None)) is None


@pytest.mark.parametrize(
    "text, strip, expected",
    [("1,234", False, None), ("1,234", True, 1234.0), (" 12 ", False, 12.0), ("1e3", False, 1000.0), ("n/a", True, None)],
)
def test_lenient_number(spark, text, strip, expected):
    assert one(spark, fn.lenient_number("c", strip), c=("string", text)) == expected


@pytest.mark.parametrize("code, expected", [("12", "0012"), ("123456", "123456"), (None, None), ("", "0000")])
def test_zero_pad(spark, code, expected):
    assert one(spark, fn.zero_pad("c", 4), c=("string", code)) == expected


@pytest.mark.parametrize("code, kept", [("2MTA", True), ("9ABC", False), ("21AB", False), ("X1ABCD", True)])
def test_product_pattern_is_not_anchored(spark, code, kept):
    from indexloom.plans.fixed_values import PRODUCT_PATTERN

    assert one(spark, fn.has_code("c", PRODUCT_PATTERN), c=("string", code)) is kept


@pytest.mark.parametrize("current, base, expected", [(110.0, 100.0, 10.0), (206.0, 160.0, 28.75), (1.0, 0.0, None), (None, 1.0, None)])
def test_pct_change(spark, current, base, expected):
    got = one(spark, fn.pct_change("a", "b"), a=("double", current), b=("double", base))
    assert got == (pytest.approx(expected) if expected is not None else None)


def test_roll_forward_and_real_change(spark):
    assert one(spark, fn.rolled_forward(F.col("p"), F.col("c")), p=("double", 200.0), c=("double", 3.0)) == 206.0
    real = fn.real_change(F.col("v"), F.col("p"), F.lit(2.5))
    assert one(spark, real, v=("double", 206.0), p=("double", 200.0)) == pytest.approx(0.4878, abs=1e-4)


def test_money_is_never_rounded(spark):
    exact = spark.createDataFrame([("£1,234.5678",), ("-0.5",), (None,)], "t string").select(fn.clean_money("t"))
    assert [None if r[0] is None else float(r[0]) for r in exact.collect()] == [1234.5678, -0.5, None]
    with pytest.raises(Exception, match="four decimals"):
        spark.createDataFrame([("1.23456",)], "t string").select(fn.clean_money("t")).collect()
