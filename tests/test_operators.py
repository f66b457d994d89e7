"""Operators: schema, lookups, de-duplication, the null-safe join."""

import pytest
from pyspark.sql import functions as F

from staysift.operators import enrich, lookup, schema


def test_canonical_columns_variants(spark):
    df = spark.createDataFrame(
        [("DE", "Germany", "x", "Berlin", "3 Star", "1|2")],
        ["﻿countyCode", " countryName", "country", "City_Name", "Hotel Rating", "ï»¿map"],
    )
    out = schema.canonical_columns(df)
    assert out.columns[:5] == ["countyCode", "countyName", "cityName", "HotelRating", "Map"]
    assert out.first().countyName == "Germany"  # first of the duplicates kept
    for c in ("Attractions", "HotelFacilities", "cityCode", "HotelCode", "HotelName"):
        assert c in out.columns


def test_missing_required_column_message(spark):
    df = spark.createDataFrame([("DE",)], ["countyCode"])
    with pytest.raises(KeyError, match="cityName"):
        schema.canonical_columns(df)


def test_rename_aliases(spark):
    df = spark.createDataFrame([(1, 2)], ["feature_count", "Feature_keywords"])
    out = schema.rename_aliases(df)
    assert set(out.columns) == {"facilities_count", "facilities_keyword_hits"}
    both = spark.createDataFrame([(1, 2)], ["facilities_count", "feature_count"])
    assert schema.rename_aliases(both).columns == ["facilities_count", "feature_count"]


def test_missing_tokens_keep_namibia(spark):
    df = spark.createDataFrame([("NA", "NA"), ("", "None"), ("DE", "x")], ["countyCode", "countyName"])
    rows = schema.null_missing_tokens(df).collect()
    assert [tuple(r) for r in rows] == [("NA", None), (None, None), ("DE", "x")]


def test_country_lookup_vectors(spark):
    dim = lookup.iso_country_dim(spark)
    vals = [("AG", "ANTIGUA"), ("AL", "Albania"), ("de ", "x"), (None, "Albania"), ("NA", "Namibia"),
            (None, "ANTIGUA"), ("ZZ", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(vals)], "i int, code string, name string")
    out = lookup.iso2_lookup(df, "code", "name", "iso2", dim).orderBy("i").collect()
    assert [r.iso2 for r in out] == ["AG", "AL", "DE", "AL", "NA", None, None]


def test_region_maps(spark):
    df = spark.createDataFrame([("Qatar",), ("Atlantis",), (None,)], "c string")
    out = df.select(lookup.sub_region("c").alias("s")).withColumn("k", lookup.continent("s")).collect()
    assert [(r.s, r.k) for r in out] == [("Middle East", "Asia"), ("Other", "Other"), ("Other", "Other")]


def _gaz(spark):
    rows = [("DE", "berlin", 10.0), ("DE", "berlin", 99.0), ("DE", "berlin", None), (None, "x", 5.0), (None, "x", 7.0)]
    return spark.createDataFrame(rows, "country_iso2 string, city_join_key string, pop double")


def test_dedupe_keep_max_fixture(spark):
    out = enrich.dedupe_keep_max(_gaz(spark), ["country_iso2", "city_join_key"], "pop")
    got = sorted((r.country_iso2 or "", r.pop) for r in out.collect())
    assert got == [("", 7.0), ("DE", 99.0)]


@pytest.mark.parametrize("broadcast_max_rows", [10**6, -1])
def test_null_safe_join_fixture(spark, broadcast_max_rows):
    gaz = enrich.dedupe_keep_max(_gaz(spark), ["country_iso2", "city_join_key"], "pop")
    left = spark.createDataFrame([(1, "DE", "berlin"), (2, None, "x"), (3, "FR", "paris")],
                                 "id int, country_iso2 string, city_join_key string")
    out = enrich.null_safe_left_join(left, gaz, ["country_iso2", "city_join_key"], ["pop"],
                                     broadcast_max_rows=broadcast_max_rows, salt_buckets=4)
    assert sorted((r.id, r.pop) for r in out.collect()) == [(1, 99.0), (2, 7.0), (3, None)]


def test_join_preserves_left_rows_and_unique_keys(spark, sf_dir):
    from staysift.plans import fixtures as fx
    from staysift.plans.jobs import clean_and_join

    r = clean_and_join(fx.listings_raw(spark, sf_dir), fx.gazetteer_raw(spark, sf_dir), fx.country_dim(spark, sf_dir))
    assert r.joined.count() == fx.listings_raw(spark, sf_dir).count()
    dupes = r.gazetteer.groupBy("country_iso2", "city_join_key").count().where("count > 1").count()
    assert dupes == 0


def test_salted_path_equals_broadcast_path(spark, sf_dir):
    from staysift.plans import fixtures as fx
    from staysift.plans.jobs import clean_and_join

    r = clean_and_join(fx.listings_raw(spark, sf_dir), fx.gazetteer_raw(spark, sf_dir), fx.country_dim(spark, sf_dir))
    a = enrich.attach_population(r.listings, r.gazetteer).select("HotelCode", "city_population")
    b = enrich.attach_population(r.listings, r.gazetteer, broadcast_max_rows=-1, salt_buckets=7).select(
        "HotelCode", "city_population")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
