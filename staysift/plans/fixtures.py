"""Listing-shaped inputs derived from the driver tables.

The driver tables hold no listings, so the registered queries derive messy
listing and gazetteer tables from ``orders``, ``customer`` and ``nation`` with
integer/CASE expressions only. The SQL here is written in the common subset of
Spark SQL and DuckDB, so the oracle builds bit-identical inputs from the same
text. Every fixture grows with its source tables (one listing per order, one
gazetteer row per customer).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from staysift.session import spread, tasks_of

LISTINGS_PER_TASK = 200_000  # texts that one task generates and parses

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Country per nation key: ISO2 code and the name as the listing data writes it.
COUNTRY_DIM_SQL = """
SELECT n_nationkey AS nationkey,
  CASE n_nationkey
    WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'US' WHEN 3 THEN 'QA' WHEN 4 THEN 'YE'
    WHEN 5 THEN 'KR' WHEN 6 THEN 'JP' WHEN 7 THEN 'BR' WHEN 8 THEN 'IN' WHEN 9 THEN 'KE'
    WHEN 10 THEN 'AU' WHEN 11 THEN 'MX' WHEN 12 THEN 'IT' WHEN 13 THEN 'ES' WHEN 14 THEN 'CN'
    WHEN 15 THEN 'TH' WHEN 16 THEN 'EG' WHEN 17 THEN 'CA' WHEN 18 THEN 'PE' WHEN 19 THEN 'TR'
    WHEN 20 THEN 'NA' WHEN 21 THEN 'AL' WHEN 22 THEN 'FJ' WHEN 23 THEN 'AG' ELSE 'XK' END AS iso2,
  CASE n_nationkey
    WHEN 0 THEN 'Germany' WHEN 1 THEN 'France' WHEN 2 THEN 'United States' WHEN 3 THEN 'Qatar'
    WHEN 4 THEN 'Yemen Republic' WHEN 5 THEN 'South Korea' WHEN 6 THEN 'Japan' WHEN 7 THEN 'Brazil'
    WHEN 8 THEN 'India' WHEN 9 THEN 'Kenya' WHEN 10 THEN 'Australia' WHEN 11 THEN 'Mexico'
    WHEN 12 THEN 'Italy' WHEN 13 THEN 'Spain' WHEN 14 THEN 'China' WHEN 15 THEN 'Thailand'
    WHEN 16 THEN 'Egypt' WHEN 17 THEN 'Canada' WHEN 18 THEN 'Peru' WHEN 19 THEN 'Turkey'
    WHEN 20 THEN 'Namibia' WHEN 21 THEN 'Albania' WHEN 22 THEN 'Fiji' WHEN 23 THEN 'Antigua'
    ELSE 'Atlantis' END AS name
FROM nation
"""

# City name per customer (messy variants; several customers share a city).
_CITY_NAME = """CASE c.c_custkey % 9
      WHEN 0 THEN ' City ' || CAST(c.c_custkey % 61 AS STRING) || '! '
      WHEN 1 THEN 'Saint-' || CAST(c.c_custkey % 61 AS STRING)
      WHEN 2 THEN 'Tōkyō'
      WHEN 3 THEN NULL
      WHEN 4 THEN 'Köln  ' || CAST(c.c_custkey % 5 AS STRING)
      ELSE 'City ' || CAST(c.c_custkey % 61 AS STRING) END"""

# One listing per order; the hotel's country and city are its customer's.
LISTINGS_RAW_SQL = f"""
SELECT
  CASE o.o_orderkey % 11
    WHEN 0 THEN NULL WHEN 1 THEN lower(d.iso2) || ' ' WHEN 2 THEN 'ZZ' WHEN 3 THEN ''
    ELSE d.iso2 END AS countyCode,
  CASE o.o_orderkey % 7
    WHEN 0 THEN NULL WHEN 1 THEN upper(d.name) ELSE d.name END AS countyName,
  CAST(c.c_custkey % 97 AS STRING) AS cityCode,
  {_CITY_NAME} AS cityName,
  CAST(o.o_orderkey AS STRING) AS HotelCode,
  'Hotel ' || CAST(o.o_orderkey AS STRING) AS HotelName,
  CASE (o.o_orderkey + c.c_nationkey) % 16
    WHEN 0 THEN 'OneStar' WHEN 1 THEN 'TwoStar' WHEN 2 THEN 'ThreeStar' WHEN 3 THEN 'FourStar'
    WHEN 4 THEN 'FiveStar' WHEN 5 THEN 'Five  Star' WHEN 6 THEN 'fivestar' WHEN 7 THEN '3 Star'
    WHEN 8 THEN '4 Stars' WHEN 9 THEN '4.5 Star' WHEN 10 THEN '10 star' WHEN 11 THEN '3-star'
    WHEN 12 THEN 'All' WHEN 13 THEN '' WHEN 14 THEN 'nan' ELSE NULL END AS HotelRating,
  CASE o.o_orderkey % 10
    WHEN 0 THEN NULL
    WHEN 1 THEN '91|10'
    WHEN 2 THEN 'abc|' || CAST(o.o_orderkey % 50 AS STRING)
    WHEN 3 THEN CAST(c.c_custkey % 170 - 85 AS STRING) || '.' || CAST(o.o_orderkey % 100 AS STRING)
                || '| ' || CAST(o.o_orderkey % 340 - 170 AS STRING)
    WHEN 4 THEN '1|2|3'
    ELSE CAST(c.c_custkey % 170 - 85 AS STRING) || '.' || CAST(o.o_orderkey % 100 AS STRING)
         || '|' || CAST(o.o_orderkey % 340 - 170 AS STRING) || '.5' END AS Map,
  CASE o.o_orderkey % 9
    WHEN 0 THEN NULL
    WHEN 1 THEN 'Museum'
    WHEN 2 THEN repeat('Sight, ', CAST(o.o_orderkey % 6 AS INTEGER)) || 'Tower'
    WHEN 3 THEN 'Berat : within ' || CAST(o.o_orderkey % 9000 AS STRING)
                || ' metre  Tower : within 4000 metre'
    WHEN 4 THEN repeat('City Museum - 1.8 km / 1.1 mi <br />', CAST(o.o_orderkey % 5 AS INTEGER))
                || 'Big Park – 2 km<br />'
    WHEN 5 THEN '<br />X - 1 km'
    WHEN 6 THEN '<p>The preferred airport for here is Y Intl - 12 km</p>'
    WHEN 7 THEN '<p>one, two</p>'
    ELSE 'Old Town - 3 km, River - 1 km <p>x</p> preferred airport - 9 km' END AS Attractions,
  CASE o.o_orderkey % 8
    WHEN 0 THEN 'Free WiFi, Bar'
    WHEN 1 THEN 'Dry cleaning/laundry, Non-smoking rooms'
    WHEN 2 THEN '<b>Pool</b> pool; Spa/Sauna'
    WHEN 3 THEN '24-hour front desk, Barbecue'
    WHEN 4 THEN NULL
    WHEN 5 THEN 'wifi, parking, room service, elevator'
    WHEN 6 THEN repeat('Garden, ', CAST(c.c_custkey % 6 AS INTEGER)) || 'Terrace'
    ELSE '' END AS HotelFacilities,
  'Street ' || CAST(o.o_orderkey % 500 AS STRING) AS Address
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN ({COUNTRY_DIM_SQL}) d ON c.c_nationkey = d.nationkey
"""

# One gazetteer row per customer; codes lower-case as in the source gazetteer.
GAZETTEER_RAW_SQL = f"""
SELECT
  CASE c.c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN upper(d.iso2) ELSE lower(d.iso2) END AS Country,
  {_CITY_NAME} AS City,
  {_CITY_NAME} AS AccentCity,
  CAST(c.c_nationkey AS STRING) AS Region,
  CASE c.c_custkey % 8
    WHEN 0 THEN NULL WHEN 1 THEN 'n/a'
    ELSE CAST((c.c_custkey * 7919) % 1000003 AS STRING) END AS Population,
  CAST(c.c_custkey % 90 AS STRING) AS Latitude,
  CAST(c.c_custkey % 180 AS STRING) AS Longitude
FROM customer c
JOIN ({COUNTRY_DIM_SQL}) d ON c.c_nationkey = d.nationkey
"""


def register_tables(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TABLES) -> None:
    """Register each driver parquet table as a temp view of the same name (a missing
    table is an error, so no view of another folder can answer instead)."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` over the driver tables. Each order becomes a listing with text to parse, so
    the orders are dealt over all cores where their file is one split, and over more tasks
    where there are many: by the key of the join that comes before the texts, as a join that
    shuffles them again would merge the tasks by the few bytes of an order."""
    register_tables(spark, sf_dir, ("nation", "customer"))
    orders = table(spark, sf_dir, "orders")
    tasks_of(spread(orders), orders.count(), LISTINGS_PER_TASK, "o_custkey").createOrReplaceTempView("orders")
    return spark.sql(sql)


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, LISTINGS_RAW_SQL)


def gazetteer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer becomes a city with text to parse: dealt over all cores like the orders."""
    register_tables(spark, sf_dir, ("nation",))
    spread(table(spark, sf_dir, "customer")).createOrReplaceTempView("customer")
    return spark.sql(GAZETTEER_RAW_SQL)


def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, COUNTRY_DIM_SQL).select("iso2", "name")
