import datetime as dt

from pyspark.sql import functions as F

from mediamart.functions import clean_title, safe_double, sanitize_columns, sunday_week, surrogate_key


def test_odd_headers():
    assert sanitize_columns([" Gross(in $)", "1st", "a b", "a-b", "$"]) == \
        ["gross_in", "c_1st", "a_b", "a_b_2", "c_"]


def test_sanitize_keeps_clean_names():
    assert sanitize_columns(["movie_id", "Movie_Name", "votes"]) == ["movie_id", "movie_name", "votes"]


def test_sunday_week_matches_percent_u(spark):
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 365 * 7, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", sunday_week("d").alias("w")).collect()}
    for d in days:
        assert got[d] == int(d.strftime("%U")), d


def test_surrogate_key_null_is_empty(spark):
    r = spark.range(1).select(
        surrogate_key(F.lit(None).cast("string"), F.lit("x")).alias("a"),
        surrogate_key(F.lit(""), F.lit("x")).alias("b"),
        F.md5(F.lit("-x")).alias("c")).first()
    assert r.a == r.b == r.c


def test_quoted_title(spark):
    r = spark.range(1).select(clean_title(F.lit('"Big" \\Film')).alias("t")).first()
    assert r.t == "Big Film"


def test_bad_ratings(spark):
    df = spark.createDataFrame([("8.1",), ("bad",), ("",), ("N/A",), ("NaN",)], "r string")
    kept = [r.v for r in df.select(safe_double("r").alias("v")).collect() if r.v is not None]
    assert kept == [8.1]


def test_sanitize_more_cases():
    assert sanitize_columns(["a__b", "_x_", "A B", "a_b", "a b", "", "9"]) == \
        ["a_b", "x", "a_b_2", "a_b_3", "a_b_4", "c_", "c_9"]
    assert sanitize_columns(["x", "x_2", "x"]) == ["x", "x_2", "x_3"]
