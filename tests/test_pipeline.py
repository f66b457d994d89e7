"""End-to-end jobs on tiny files: cleaning job, CSV encodings, streaming."""

import os
import tempfile

from pyspark.sql import functions as F

from staysift.plans.jobs import run_cleaning
from staysift.sources import readers


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_tiny_cleaning_job(spark):
    work = tempfile.mkdtemp(prefix="staysift-test-")
    hp, wp = os.path.join(work, "hotels.csv"), os.path.join(work, "world.csv")
    _write(hp, "countyCode,countyName,cityCode,cityName,HotelCode,HotelName,HotelRating,Map,Attractions,HotelFacilities\n"
               "DE,Germany,1,Berlin,9,Boutique,ThreeStar,52.5|13.4,Museum,WiFi\n")
    _write(wp, "Country,City,AccentCity,Region,Population,Latitude,Longitude\n"
               "de,berlin,Berlin,11,3700000,52.5,13.4\n")
    for fmt in ("csv", "parquet"):
        written = run_cleaning(spark, hp, wp, os.path.join(work, f"out-{fmt}"), output_format=fmt)
        assert set(written) == {"hotels_clean", "world_cities_clean", "hotels_with_cities"}
    joined = spark.read.parquet(written["hotels_with_cities"]).first()
    assert joined.hotel_star_rating == 3
    assert joined.city_population == 3700000.0
    assert (joined.attractions_count, joined.facilities_count, joined.facilities_keyword_hits) == (0, 1, 1)


def test_encoding_fallback_and_bom(spark):
    work = tempfile.mkdtemp(prefix="staysift-test-")
    p = os.path.join(work, "latin.csv")
    with open(p, "wb") as f:
        f.write("countyCode,cityName,HotelRating,Map\nDE,Köln,FourStar,1|2\n".encode("latin-1"))
    df = readers.read_listings_csv(spark, p)
    assert df.first().cityName == "Köln"
    assert readers.read_text_csv(spark, p, fallback="file").first().cityName == "Köln"
    p3 = os.path.join(work, "utf8.csv")
    _write(p3, "countyCode,cityName,HotelRating,Map\nDE,Tōkyō,FourStar,1|2\n")
    assert readers.read_listings_csv(spark, p3).first().cityName == "Tōkyō"
    p2 = os.path.join(work, "bom.csv")
    with open(p2, "wb") as f:
        f.write("﻿countyCode,cityName,HotelRating,Map\nNA,Windhoek,OneStar,1|2\n".encode("utf-8"))
    df2 = readers.read_listings_csv(spark, p2)
    assert "countyCode" in df2.columns and df2.first().countyCode == "NA"
    p4 = os.path.join(work, "variant.csv")
    _write(p4, "County_Code,City Name,Hotel Rating,Map\nNA,Windhoek,NA,1|2\n")
    row = readers.read_listings_csv(spark, p4).first()
    assert (row["County_Code"], row["Hotel Rating"]) == ("NA", None)


def test_find_table_file(spark):
    work = tempfile.mkdtemp(prefix="staysift-test-")
    spark.range(3).write.parquet(os.path.join(work, "a", "hotels_with_cities-2.parquet"))
    spark.range(3).write.parquet(os.path.join(work, "b", "hotels_with_cities.parquet"))
    found = readers.find_table_file(spark, work, "hotels_with_cities")
    assert found.endswith("b/hotels_with_cities.parquet")
    assert spark.read.parquet(found).count() == 3


def test_stream_matches_batch(spark, sf_dir):
    import __spark_entry__ as E

    q = E.queries()
    a = q["stream_enrich"](spark, sf_dir)
    b = q["null_safe_left_join"](spark, sf_dir)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 5 and "hotel_star_rating" in df.columns


def test_analysis_jobs(spark, sf_dir):
    from staysift.plans import jobs
    from staysift.plans.queries import written_joined_table
    from staysift.plans import fixtures as fx

    joined = written_joined_table(spark, sf_dir)
    prof = jobs.profile_report(joined)
    assert prof["shape"].first().columns == 13
    eda = jobs.eda_results(joined)
    assert eda["top_countries"].count() == 10
    assert eda["correlation"].count() == 49
    raw = fx.listings_raw(spark, sf_dir).withColumn("Description", F.col("Attractions"))
    exp = jobs.expand_features(raw)
    tests = jobs.expanded_tests(exp)
    assert tests["effect_size"].first().interpretation in {"negligible", "small", "medium", "large"}
    assert tests["mann_whitney"].first().p_value <= 1.0
    assert tests["box_by_attractions"].count() >= 1


def test_train_and_permutation_jobs(spark, sf_dir):
    from staysift.plans import jobs
    from staysift.plans.queries import written_joined_table

    joined = written_joined_table(spark, sf_dir)
    work = tempfile.mkdtemp(prefix="staysift-test-")
    res = jobs.train_job(joined, os.path.join(work, "run"), "linear", sample=3000)
    assert res["rows"] == 3000 and res["metrics"]["rmse"] > 0
    back = readers.read_run_metrics(spark, os.path.join(work, "run", "metrics", "*"))
    assert back.first().model == "linear"
    rep = jobs.permutation_report(joined, os.path.join(work, "perm"), n_permutations=20, sample=2000)
    rows = {r.feature: r for r in rep.collect()}
    assert set(rows) == {"city_population", "attractions_count"}
    assert all(1 / 21 <= r.empirical_p_value_two_sided <= 1 for r in rows.values())


def test_union_sources(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    out = readers.union_sources([a, b]).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in out] == [(1, "x", None), (2, None, 3.0)]
