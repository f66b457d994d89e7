"""Edge-case vectors for the column expressions (see FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

import staysift.functions as X


def _apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def test_star_rating(spark):
    vals = ["FourStar", "Five  Star", "fivestar", "3 Star", "4 Stars", "4.5 Star",
            "10 star", "0star", "3-star", "All", "", "nan", None]
    assert _apply(spark, vals, X.star_rating) == [4, 5, 5, 3, 4, 5] + [None] * 7
    assert _apply(spark, vals, X.strict_star_rating) == [4] + [None] * 12


def test_lat_lon(spark):
    vals = ["41.0|19.0", "41.0| 19.0", "1e1|2", "91|10", "10|181", "41d|3", "inf|2",
            "nan|1", "5", "1|2|3", "+4.5|1_0", None, "90|-180"]
    lat = _apply(spark, vals, lambda c: X.lat_lon(c)[0])
    lon = _apply(spark, vals, lambda c: X.lat_lon(c)[1])
    assert lat == [41.0, 41.0, 10.0] + [None] * 9 + [90.0]
    assert lon == [19.0, 19.0, 2.0] + [None] * 9 + [-180.0]


def test_city_join_key(spark):
    vals = [" New York! ", "Saint-Denis", "Köln", "St.  John's", "東京", "!!!", None]
    assert _apply(spark, vals, X.city_join_key) == [
        "new york", "saint-denis", "kln", "st johns", "", "", ""]


def test_attractions_count(spark):
    vals = [
        "a, b", "Museum", "a,", ",",
        "Berat : within 130000 metre  Tower : within 4000 metre",
        "City Museum - 1.8 km / 1.1 mi <br />Big Park – 2 km<br />",
        "<br />X - 1 km",
        "<p>The preferred airport for here is Y Intl - 12 km</p>",
        "<p>one, two</p>", None, "", "nan",
    ]
    assert _apply(spark, vals, X.attractions_count) == [2, 0, 1, 0, 2, 2, 1, 0, 2, 0, 0, 0]


def test_facility_tokens(spark):
    vals = ["wifi, parking", "WiFi", "a/b;c", "<b>x</b> y", ",", None]
    assert _apply(spark, vals, X.facility_token_count) == [2, 1, 3, 2, 0, 0]


def test_keyword_hits(spark):
    vals = ["Free WiFi, Bar", "Barbecue", "Dry cleaning/laundry", "Non-smoking rooms",
            "24-hour front desk", "pool pool", None, "", "nan", "WiFi"]
    assert _apply(spark, vals, X.keyword_hits) == [3, 0, 3, 2, 1, 1, 0, 0, 0, 1]


def test_labels(spark):
    assert _apply(spark, [0.009, 0.01, 0.05], X.p_value_label, "double") == [
        "strong evidence against null", "moderate evidence against null",
        "no significant evidence"]
    assert _apply(spark, [0.19, 0.2, -0.5, 0.8], X.effect_size_label, "double") == [
        "negligible", "small", "medium", "large"]


def test_raw_tokens_length_flag(spark):
    vals = ["a  b\tc", "", None, "<b>x</b> y"]
    assert _apply(spark, vals, X.raw_token_count) == [3, 0, 0, 2]
    assert _apply(spark, vals, X.text_length) == [6, 0, 0, 10]
    assert _apply(spark, vals, X.presence_flag) == [1, 1, 0, 1]


def test_to_number(spark):
    vals = ["1e1", "+4.5", " 19.0", "41d", "1_0", "nan", "inf", "abc", None, ".5"]
    assert _apply(spark, vals, X.to_number) == [
        10.0, 4.5, 19.0, None, None, None, float("inf"), None, None, 0.5]
