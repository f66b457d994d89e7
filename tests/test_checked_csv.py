"""Rejected rows of CSV sources."""

import os
import tempfile

import pytest

from staysift.plans import jobs
from staysift.sources.checked_csv import RejectedRowsError, land_csv

LISTINGS = (
    "﻿countyCode, countyName,cityCode,cityName,HotelCode,HotelName,HotelRating,Map,Attractions,HotelFacilities\n"
    'NA,Namibia,1,Windhoek,h1,One,ThreeStar,1|2,"a, b","wifi, ""bar""\npool"\n'
    "DE,Germany,2,Berlin,h2,Two,FourStar,1|2,x,y,surplus,more\n"
    "DE,Germany,2,Berlin,h3\n"
    "\n"
    "DE,Germany,2,Köln,h4,Four,FiveStar,1|2,,\n"
)
CITIES = "Country,City,Population\nna,Windhoek,300\nde,Köln,9,surplus\nde,Köln,10\n"


@pytest.fixture
def folder():
    base = tempfile.mkdtemp(prefix="staysift-test-")
    for name, text, charset in (("listings", LISTINGS, "utf-8"), ("cities", CITIES, "utf-8"), ("latin", LISTINGS[1:], "latin-1")):
        with open(f"{base}/{name}.csv", "w", encoding=charset, newline="") as f:
            f.write(text)
    return base


@pytest.mark.parametrize("name", ["listings", "latin"])
def test_rows_are_kept_or_rejected(spark, folder, name):
    landed = land_csv(spark, f"{folder}/{name}.csv", f"{folder}/landing-{name}", max_rejected_share=0.5)
    assert (landed.rows, landed.rejected_rows) == (4, 2)
    kept = {r["HotelCode"]: r for r in landed.kept.collect()}
    assert set(kept) == {"h1", "h4"}
    assert kept["h1"]["HotelFacilities"] == 'wifi, "bar"\npool' and kept["h4"]["cityName"] == "Köln"
    bad = landed.rejected.orderBy("fields").collect()
    assert [(r["reason"], r["fields"], r["expected"]) for r in bad] == [("too few fields", 5, 10), ("too many fields", 12, 10)]
    assert bad[1]["raw"] == "DE,Germany,2,Berlin,h2,Two,FourStar,1|2,x,y,surplus,more" and bad[0]["file"].endswith(f"{name}.csv")


def test_too_many_rejected_rows_fail_the_job(spark, folder):
    with pytest.raises(RejectedRowsError, match="2 of 4 rows"):
        land_csv(spark, f"{folder}/listings.csv", f"{folder}/landing", max_rejected_share=0.4)
    assert os.path.isdir(f"{folder}/landing/__rejected=true")  # the rows can be looked at


def test_limit_unclosed_quote_and_header_alone(spark, folder):
    assert land_csv(spark, f"{folder}/listings.csv", f"{folder}/a", limit=1).rows == 1
    with open(f"{folder}/odd.csv", "w") as f:
        f.write('a,b,c\n1,2,3\n3,"open,4\n')
    odd = land_csv(spark, f"{folder}/odd.csv", f"{folder}/b", max_rejected_share=1.0)
    assert [tuple(r) for r in odd.kept.collect()] == [("1", "2", "3")]
    assert [r["reason"] for r in odd.rejected.collect()] == ["unclosed quote"]
    with open(f"{folder}/none.csv", "w") as f:
        f.write("a,b\n")
    none = land_csv(spark, f"{folder}/none.csv", f"{folder}/c")
    assert (none.rows, none.rejected_rows, none.kept.columns) == (0, 0, ["a", "b"])


def test_cleaning_job_sets_rejected_rows_apart(spark, folder):
    run = lambda out, **more: jobs.run_cleaning(spark, f"{folder}/listings.csv", f"{folder}/cities.csv", f"{folder}/{out}", **more)
    with pytest.raises(RejectedRowsError):
        run("strict")
    paths = run("out", max_rejected_share=0.5)
    joined = spark.read.parquet(paths["hotels_with_cities"])
    assert {r["HotelCode"]: r["city_population"] for r in joined.collect()} == {"h1": 300.0, "h4": 10.0}
    assert spark.read.parquet(paths["hotels_rejected"]).count() == 2
    assert spark.read.parquet(paths["world_cities_rejected"]).count() == 1
    kept = run("kept", malformed="keep")
    assert spark.read.parquet(kept["hotels_clean"]).count() == 4 and "hotels_rejected" not in kept
