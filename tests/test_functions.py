import datetime as dt
import math

from pyspark.sql import functions as F

from starmill.functions import (
    clip, coerce_numeric, date_parts, first_token, nan_to_null, ordered_pair, strip_ws, to_long, to_numeric,
    weekday_text,
)


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr.alias("x")).first().x


def test_numbers_from_text(spark):
    cases = {
        "\\N": None, "": None, "12d": None, "12f": None, "1_0": None, "0x10": None, "NaN": None, "abc": None,
        "1 2": None, "0x1p3": None, "1.f": None, "1D": None, "1e400x": None, " 12 ": 12.0, "\t7\n": 7.0, "1e3": 1000.0, "-.5": -0.5, "+3.": 3.0, "inf": math.inf,
        "-Infinity": -math.inf, ".": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.x for r in df.select("v", to_numeric("v").alias("x")).collect()}
    assert got == cases


def test_long_from_text(spark):
    cases = {"9223372036854775807": 2**63 - 1, "9223372036854775808": None, "1.0": None, " 5 ": 5, "\\N": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.x for r in df.select("v", to_long("v").alias("x")).collect()} == cases


def test_nan_is_null_before_comparison(spark):
    df = spark.createDataFrame([(math.nan,), (7.0,), (None,)], "v double")
    assert df.filter(F.col("v") >= 6.0).count() == 2  # NaN counts as large
    assert df.select(nan_to_null("v").alias("v")).filter(F.col("v") >= 6.0).count() == 1


def test_coerce_any_type(spark):
    df = spark.createDataFrame([("3", math.nan, 4)], "a string, b double, c int")
    out = coerce_numeric(df, ["a", "b", "c"])
    assert [t for _, t in out.dtypes] == ["double"] * 3
    assert tuple(out.first()) == (3.0, None, 4.0)


def test_first_token(spark):
    cases = {"Drama,Crime": "Drama", None: "desconhecido", "": "", "\t Drama  ,x": "Drama", "\\N": "\\N"}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.x for r in df.select("v", first_token("v").alias("x")).collect()} == cases
    assert one(spark, "\\N", "string", first_token("v", null_marker="\\N")) == "desconhecido"
    assert one(spark, " a ,b", "string", first_token("v", unknown=None, strip=False)) == " a "
    assert one(spark, None, "string", first_token("v", unknown=None)) is None


def test_strip_all_whitespace(spark):
    assert one(spark, " \x1f x y \r\n", "string", strip_ws("v")) == "x y"


def test_clip_keeps_null(spark):
    assert [one(spark, v, "double", clip("v", 1.0, 5.0)) for v in (0.2, 3.0, 9.0, None)] == [1.0, 3.0, 5.0, None]


def test_ordered_pair(spark):
    df = spark.createDataFrame([(5, 2), (1, 3)], "a int, b int")
    lo, hi = ordered_pair("a", "b")
    assert [tuple(r) for r in df.select(lo, hi).collect()] == [(2, 5), (1, 3)]


def test_weekday_styles(spark):
    day = dt.date(2024, 1, 1)
    assert one(spark, day, "date", weekday_text("v")) == "Mon"
    assert one(spark, day, "date", weekday_text("v", "padded")) == "Monday   "


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 11, 30),)], "v date")
    assert tuple(df.select(*date_parts("v")).first()) == ("Sat", 30, 11, 4, 2024)
