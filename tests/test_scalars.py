import datetime as dt

from pyspark.sql import functions as F

from ebbtide.functions import scalars as S


def one_column(spark, values, type_="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")


def results(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_days_that_do_not_exist_are_null(spark):
    df = one_column(spark, ["20170228", "20170231", "20171399", "2017131", "20170101 ", "2017-01-01", "", None])
    day = dt.date
    assert results(df, S.parse_day(F.col("v"))) == [
        day(2017, 2, 28), None, None, None, day(2017, 1, 1), None, None, None,
    ]
    assert results(df, S.month_of(F.col("v"))) == ["201702", None, None, None, "201701", None, None, None]


def test_text_to_whole_number(spark):
    df = one_column(spark, ["1.6", "1e2", "", "abc", " 1 ", "-1.5", "2.5", "nan", "1e12", None])
    assert results(df, S.whole(F.col("v"))) == [2, 100, None, None, 1, -2, 3, None, None, None]


def test_only_decimal_text_is_a_number(spark):
    df = one_column(spark, ["30D", "30f", "0x1p3", "1e3", "-.5", "7.", "Infinity", "-inf", "NaN", "1_000", "+4"])
    found = results(df, S.real(F.col("v")))
    assert found[:8] == [None, None, None, 1000.0, -0.5, 7.0, float("inf"), float("-inf")]
    assert found[8] != found[8] and found[9:] == [None, 4.0]
    df = one_column(spark, [1.5e300, float("inf"), -2e-7, None], "double")
    assert results(df, S.real(F.col("v"))) == [1.5e300, float("inf"), -2e-7, None]


def test_finite_comes_before_comparison(spark):
    inf, nan = float("inf"), float("nan")
    df = one_column(spark, [1.0, nan, inf, -inf, None], "double")
    assert results(df, S.is_finite(F.col("v"))) == [True, False, False, False, False]


def test_months_are_boundaries_crossed(spark):
    df = one_column(spark, ["20160115", "20160101", "20170201", "20170331"])
    end = S.month_start(F.lit("201702"))
    assert results(df, S.months_crossed(S.parse_day(F.col("v")), end)) == [13, 13, 0, -1]


def test_month_shift_crosses_years(spark):
    df = one_column(spark, ["201702", "201612"])
    assert results(df, S.shift_month(F.col("v"), -3)) == ["201611", "201609"]


def test_capacity_uses_double_arithmetic(spark):
    df = spark.createDataFrame([(0, 1), (1, 9), (2, 10), (3, 11), (4, 198587)], "i int, n bigint")
    assert results(df, S.share_of(F.col("n"), 0.10)) == [1, 1, 1, 2, 19859]
