"""Column functions: sentinels, numbers, periods, keys, rounding, bands."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keyfig.functions import columns as C


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [(":", None), ("", None), ("<NA>", None), ("nan", None),
                                            ("12d", None), (" 12 ", 12.0), ("..", None), ("1e3", 1000.0),
                                            ("Infinity", None), ("-3.5", -3.5)])
def test_parse_number_sentinels(spark, text, expected):
    assert one(spark, C.parse_number, text) == expected


def test_parse_number_decimal_comma(spark):
    assert one(spark, lambda c: C.parse_number(c, decimal_comma=True), "102,5") == 102.5


@pytest.mark.parametrize("text,expected", [("2023X1", None), ("2023M13", None), ("2023", dt.date(2023, 1, 1)),
                                            ("2023K3", dt.date(2023, 7, 1)), ("2023Q3", dt.date(2023, 7, 1)),
                                            ("2023M06", dt.date(2023, 6, 1)), ("2023\n", None)])
def test_period_to_date(spark, text, expected):
    assert one(spark, C.period_to_date, text) == expected


def test_strict_int_fails_on_bad_input(spark):
    assert one(spark, C.strict_int, "2023") == 2023
    with pytest.raises(Exception):
        one(spark, C.strict_int, "20x3")


def test_surrogate_key_convention(spark):
    import hashlib
    got = spark.range(1).select(C.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(2023)).alias("k")).first()["k"]
    assert got == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-2023").hexdigest()


def test_round_half_up_ties(spark):
    assert one(spark, lambda c: C.round_half_up(c, 2), 1.675, "double") == 1.68
    assert one(spark, lambda c: C.round_half_up(c, 2), 2.675, "double") == 2.68
    assert one(spark, lambda c: C.round_half_up(c, 1), float("nan"), "double") is None


@pytest.mark.parametrize("ratio,tier", [(None, None), (10.0, "MODERATE_UNAFFORDABILITY"),
                                        (10.01, "HIGH_UNAFFORDABILITY"), (7.0, "AFFORDABLE"), (7.5, "MODERATE_UNAFFORDABILITY")])
def test_band_edges(spark, ratio, tier):
    assert one(spark, C.band, ratio, "double") == tier


def test_safe_ratio_guards(spark):
    df = spark.createDataFrame([(2.55, 255000.0), (1.0, 0.0), (None, 5.0)], "n double, d double")
    got = [r[0] for r in df.select(C.safe_ratio("n", "d", 1_000_000, 2)).collect()]
    assert got == [10.0, None, None]


def test_normalise_header():
    assert C.normalise_header("\ufeff Område ") == "OMRÅDE"
    assert C.normalise_header("loaded at") == "LOADED_AT"
    assert C.normalise_header(" \tloaded\u00a0  at\ufeff") == "LOADED_AT"   # any blanks, runs count once
    assert C.normalise_header("omra\u030ade") == "OMRÅDE"                    # letter and mark are one letter
    assert C.normalise_header("\ufeff") == ""


@pytest.mark.parametrize("value,digits,expected", [
    (0.4999996, 0, 0.0), (0.5, 0, 1.0), (-0.5, 0, -1.0), (1e21, 2, 1e21), (3e300, 0, 3e300), (-1e25, 1, -1e25),
    (2.0**52 + 1, 1, 2.0**52 + 1), (4503599627370495.5, 0, 4503599627370496.0), (1e-9, 2, 0.0), (float("inf"), 2, None)])
def test_rounding_is_done_once_and_has_no_limit(spark, value, digits, expected):
    assert one(spark, lambda c: C.round_half_up(c, digits), value, "double") == expected


def test_exact_mean_does_not_depend_on_the_order_of_rows(spark):
    values = [0.1] * 10 + [1e14, -1e14, 0.35, None]
    for rows in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in rows], "v double").coalesce(1)
        got = df.agg(C.exact_sum("v").alias("s"), C.exact_avg("v").alias("a")).first()
        assert (got["s"], got["a"]) == (1.35, 1.35 / 13)
    big = spark.createDataFrame([(1e22,), (1.0,)], "v double").agg(C.exact_sum("v").alias("s")).first()["s"]
    assert big == 1e22
    assert spark.createDataFrame([], "v double").agg(C.exact_avg("v").alias("a")).first()["a"] is None
