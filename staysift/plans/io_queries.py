"""Registered queries of the readers, sinks and composed jobs: each writes what it
needs to the shared scratch folder and returns what it reads back."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staysift.operators import features, lookup, models, schema
from staysift.plans import fixtures as fx
from staysift.plans import jobs
from staysift.plans import oracle_sql as O
from staysift.session import scratch_path
from staysift.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]

# Country names and their codes: short names that the ISO table spells otherwise, and
# spellings of the listing data that are no short names (no code). Held here as literals so
# that the oracle does not depend on the code it checks.
NAME_CODES = {
    "United Kingdom": "GB", "South Korea": "KR", "Myanmar": "MM", "Samoa": "WS", "Brunei Darussalam": "BN",
    "Eswatini": "SZ", "Bosnia and Herzegovina": "BA", "St. Lucia": "LC", "Trinidad and Tobago": "TT", "Germany": "DE",
    "Namibia": "NA", "Antigua": None, "Turks & Caicos Islan": None, "St Vincent & Grenadi": None, "Atlantis": None,
}


def _dir(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staysift.plans.queries import written_joined_table

    return written_joined_table(spark, sf_dir)


def q_csv_multiline_roundtrip(spark, sf_dir):
    """Values with line breaks, quotes and commas survive the listings reader."""
    raw = fx.listings_raw(spark, sf_dir)
    text = F.concat(F.lit("line one, "), F.col("HotelName"), F.lit('\nsaid "two"\n\nend of '), F.col("HotelCode"))
    path = sinks.write_table(raw.withColumn("Attractions", text), _dir(spark, "csv"), "csv")
    return readers.read_listings_csv(spark, path).select("HotelCode", "cityCode", "Attractions")


CSV_HEADER = "custkey,name,nation,note"


def csv_lines(customer: DataFrame) -> DataFrame:
    """A CSV record per customer: most fit the header of four columns, with quoted commas, quotes
    and line breaks among them; some have surplus fields and some too few."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    name = F.col("c_name")
    kind = F.col("c_custkey") % 20
    line = (
        F.when(kind == 0, F.concat_ws(",", key, name, nation, F.lit("a"), F.lit("surplus"), F.lit('"more, quoted"')))
        .when(kind == 7, F.concat_ws(",", key, name))
        .when(kind == 11, F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit(', ""x"""')), nation, F.lit('"one\ntwo"')))
        .when(kind == 12, F.concat_ws(",", key, name, nation, F.lit("")))
        .otherwise(F.concat_ws(",", key, name, nation, F.lit("Köln")))
    )
    return customer.select(line.alias("value"))


def write_csv_lines(lines: DataFrame, path: str, header: str = CSV_HEADER) -> str:
    """Lines as CSV files, each with the header."""

    def with_header(frames):
        yield pd.DataFrame({"value": [header]})
        yield from frames

    lines.mapInPandas(with_header, "value string").write.text(path)
    return path


def q_csv_rejects(spark, sf_dir):
    """Every record of a CSV with malformed rows, kept or rejected with its reason."""
    from staysift.sources.checked_csv import land_csv

    path = write_csv_lines(csv_lines(fx.table(spark, sf_dir, "customer").repartition(4)), _dir(spark, "csv"))
    landed = land_csv(spark, path, _dir(spark, "landing"), max_rejected_share=0.2)
    none = F.lit(None).cast("string")
    kept = landed.kept.select(
        F.col("custkey").cast("bigint").alias("c_custkey"), F.lit("kept").alias("status"), none.alias("reason"),
        F.lit(None).cast("int").alias("fields"), "name", F.col("nation").cast("int").alias("nation"), "note",
    )
    rejected = landed.rejected.select(
        F.split_part("raw", F.lit(","), F.lit(1)).cast("bigint").alias("c_custkey"), F.lit("rejected").alias("status"),
        "reason", "fields", none.alias("name"), F.lit(None).cast("int").alias("nation"), none.alias("note"),
    )
    return kept.unionByName(rejected)


def q_country_lookup_default_dim(spark, sf_dir):
    """Names through the default country dimension, one per customer in turn."""
    names = F.array(*[F.lit(n) for n in NAME_CODES])
    c = fx.table(spark, sf_dir, "customer")
    c = c.select("c_custkey", F.element_at(names, (F.col("c_custkey") % len(NAME_CODES) + 1).cast("int")).alias("name"))
    out = lookup.iso2_lookup(c, None, "name", "iso2", lookup.iso_country_dim(spark))
    return out.select("c_custkey", "name", "iso2")


def q_gazetteer_csv(spark, sf_dir):
    """The gazetteer CSV read with only the columns that cleaning needs."""
    path = sinks.write_table(fx.gazetteer_raw(spark, sf_dir), _dir(spark, "csv"), "csv")
    return readers.read_gazetteer_csv(spark, path).select("Country", "City", "Population")


def q_union_sources(spark, sf_dir):
    """Two deliveries, one without optional columns, united and canonicalised."""
    raw = fx.listings_raw(spark, sf_dir)
    even = F.col("HotelCode").cast("bigint") % 2 == 0
    both = readers.union_sources([raw.where(even), raw.where(~even).drop("Attractions", "HotelFacilities", "Address")])
    without = schema.canonical_columns(both.drop("cityCode"))
    return without.select("HotelCode", "cityCode", "cityName", "Attractions", "HotelFacilities")


def q_read_joined(spark, sf_dir):
    """The joined table under an alias column name, found by its stem and read back."""
    base = _dir(spark, "find")
    t = _joined(spark, sf_dir).withColumnRenamed("facilities_keyword_hits", "Feature_keywords")
    sinks.write_table(t, os.path.join(base, "deep", "hotels_with_cities.parquet"))
    found = readers.find_table_file(spark, base, "hotels_with_cities")
    return readers.read_joined(spark, found).select("HotelCode", "facilities_keyword_hits", "city_population")


def q_read_catalogue(spark, sf_dir):
    """Data sets by name, in any case, as text columns, and with all columns (expanded)."""
    path = sinks.write_table(fx.table(spark, sf_dir, "customer"), _dir(spark, "csv"), "csv")
    by_name = readers.read_datasets(spark, {"Customer": path}, ["CUSTOMER"])["CUSTOMER"]
    wide = readers.read_expanded_source(spark, path)
    plain = readers.read_text_csv(spark, path)
    parts = [d.select(F.lit(tag).alias("source"), "c_custkey", "c_name") for tag, d in (("catalogue", by_name), ("expanded", wide), ("text", plain))]
    return parts[0].union(parts[1]).union(parts[2])


def _first_file(df: DataFrame, order: list, path: str) -> str:
    """Write ``df`` in the given order as CSV files and name the first of them."""
    sinks.write_table(df.orderBy(*order), path, "csv")
    return f"{path}/part-00000*"


def q_peek(spark, sf_dir):
    """The first rows and the first raw lines of a sorted CSV."""
    customers = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    path = _first_file(customers, ["c_custkey"], _dir(spark, "csv"))
    rows = readers.peek(spark, path, 5).select(F.lit("row").alias("kind"), F.concat_ws(",", "c_custkey", "c_name").alias("value"))
    return rows.union(readers.head_lines(spark, path, 3).select(F.lit("line"), "value"))


def q_first_listings(spark, sf_dir):
    """The listings reader's first rows (its limit) of a sorted CSV."""
    listings = fx.listings_raw(spark, sf_dir).select("HotelCode", "HotelName", "cityCode", "countyCode")
    path = _first_file(listings, [F.col("HotelCode").cast("bigint")], _dir(spark, "csv"))
    return readers.read_listings_csv(spark, path, columns="all", limit=7).select("HotelCode", "HotelName", "cityCode")


def q_run_metrics(spark, sf_dir):
    """Metrics documents of three runs, read back together and ranked by RMSE."""
    from staysift.plans.queries import LINEAR_FIXTURE, rnd

    fx.register_tables(spark, sf_dir, ("lineitem",))
    rows = spark.sql(LINEAR_FIXTURE)
    base = _dir(spark, "runs")
    for run, scale in (("half", 0.5), ("third", 0.33), ("none", 0.0)):
        scored = rows.select(F.col("x1").alias("label"), (F.col("y") * scale).alias("prediction"))
        sinks.write_json_doc(spark, models.regression_metrics(scored).first().asDict(), f"{base}/{run}")
    found = readers.read_run_metrics(spark, f"{base}/*")
    order = Window.orderBy("rmse", "run")  # one row per run
    return found.select("run", F.row_number().over(order).alias("place"), rnd("rmse").alias("rmse"), rnd("mae").alias("mae"), "n")


def q_cleaning_job(spark, sf_dir):
    """The whole cleaning job from CSV files to the written joined table."""
    base = _dir(spark, "cleaning")
    hotels = sinks.write_table(fx.listings_raw(spark, sf_dir), os.path.join(base, "hotels"), "csv")
    cities = sinks.write_table(fx.gazetteer_raw(spark, sf_dir), os.path.join(base, "cities"), "csv")
    written = jobs.run_cleaning(
        spark, hotels, cities, os.path.join(base, "out"), country_dim=fx.country_dim(spark, sf_dir)
    )
    return spark.read.parquet(written[schema.JOINED_TABLE_STEM]).select("HotelCode", "hotel_star_rating", "city_population")


def q_train_job(spark, sf_dir):
    """The training job's written metrics document: split sizes and model."""
    out = _dir(spark, "run")
    jobs.train_job(_joined(spark, sf_dir), out, "linear")
    back = readers.read_run_metrics(spark, os.path.join(out, "metrics", "*"))
    return back.select(
        "model", "rows", F.col("X_train_shape")[0].alias("train_rows"), F.col("X_test_shape")[0].alias("test_rows")
    )


def q_feature_bundle(spark, sf_dir):
    """Feature matrices and their constants written as a bundle; the reloaded constants
    transform the rows as the fitted ones did."""
    from staysift.plans.queries import _matrices

    fm = _matrices(spark, sf_dir)
    paths = sinks.save_feature_bundle(_dir(spark, "bundle"), fm, {"label": "hotel_star_rating"})
    prep = features.load_feature_prep(spark, paths["preprocessor"])
    parts = [
        spark.read.parquet(paths[p]).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(p).alias("part"), "rows")
        for p in ("train", "test")
    ]
    same = prep.feature_names == fm.prep.feature_names
    return parts[0].union(parts[1]).withColumn("same_features", F.lit(same))


def q_named_coefficient(spark, sf_dir):
    """A coefficient picked by its feature's name."""
    from staysift.plans.queries import LINEAR_FIXTURE, _sql_fixture, rnd

    data = _sql_fixture(spark, sf_dir, LINEAR_FIXTURE, ("lineitem",))
    data = VectorAssembler(inputCols=["x1"], outputCol="features").transform(data).withColumnRenamed("y", "label")
    value = models.coefficient(models.linear().setSolver("normal").fit(data), ["x1"], "x1")
    return spark.createDataFrame([("x1", value)], "feature string, coefficient double").withColumn(
        "coefficient", rnd("coefficient", 4)
    )


def q_permutation_report(spark, sf_dir):
    """The permutation job's written report, read back."""
    out = _dir(spark, "report")
    jobs.permutation_report(_joined(spark, sf_dir), out)
    return spark.read.json(out).select("feature", "n_permutations", "null_hypothesis")


REGISTRY: dict[str, Query] = {
    "csv_multiline_roundtrip": q_csv_multiline_roundtrip,
    "country_lookup_default_dim": q_country_lookup_default_dim,
    "gazetteer_csv": q_gazetteer_csv,
    "union_sources": q_union_sources,
    "read_joined": q_read_joined,
    "read_catalogue": q_read_catalogue,
    "peek": q_peek,
    "first_listings": q_first_listings,
    "run_metrics": q_run_metrics,
    "csv_rejects": q_csv_rejects,
    "cleaning_job": q_cleaning_job,
    "train_job": q_train_job,
    "feature_bundle": q_feature_bundle,
    "named_coefficient": q_named_coefficient,
    "permutation_report": q_permutation_report,
}


def oracles() -> dict[str, str]:
    from staysift.plans.queries import LINEAR_FIXTURE

    raw = f"WITH listings_raw AS ({fx.LISTINGS_RAW_SQL})\n"
    names = list(NAME_CODES)
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    codes = " ".join(f"WHEN {i} THEN '{NAME_CODES[n]}'" for i, n in enumerate(names) if NAME_CODES[n])
    # the missing-value marks of the fixture's city and population columns
    blank = lambda c: f"CASE WHEN ltrim({c}) IN ('n/a', '') THEN NULL ELSE ltrim({c}) END"
    test = "(SELECT CAST(ceil(sum(cnt) * CAST(0.2 AS DOUBLE)) AS BIGINT) FROM n)"
    rated = """n AS (SELECT hotel_star_rating, count(*) AS cnt FROM joined WHERE hotel_star_rating IS NOT NULL GROUP BY 1),
        s AS (SELECT CAST(sum(cnt) AS BIGINT) AS total FROM n)"""
    return {
        "csv_multiline_roundtrip": raw + """SELECT HotelCode, cityCode,
            'line one, ' || HotelName || chr(10) || 'said "two"' || chr(10) || chr(10) || 'end of ' || HotelCode AS Attractions
            FROM listings_raw""",
        "csv_rejects": """WITH k AS (SELECT *, c_custkey % 20 AS kind FROM customer)
            SELECT c_custkey, CASE WHEN kind IN (0, 7) THEN 'rejected' ELSE 'kept' END AS status,
                CASE kind WHEN 0 THEN 'too many fields' WHEN 7 THEN 'too few fields' END AS reason,
                CAST(CASE kind WHEN 0 THEN 6 WHEN 7 THEN 2 END AS INTEGER) AS fields,
                CASE WHEN kind IN (0, 7) THEN NULL WHEN kind = 11 THEN c_name || ', "x"' ELSE c_name END AS name,
                CASE WHEN kind NOT IN (0, 7) THEN CAST(c_nationkey AS INTEGER) END AS nation,
                CASE WHEN kind IN (0, 7, 12) THEN NULL WHEN kind = 11 THEN 'one' || chr(10) || 'two' ELSE 'Köln' END AS note
            FROM k""",
        "country_lookup_default_dim": f"""SELECT c_custkey, CASE c_custkey % {len(names)} {arms} END AS name,
            CASE c_custkey % {len(names)} {codes} END AS iso2 FROM customer""",
        "gazetteer_csv": f"""SELECT Country, {blank('City')} AS City, {blank('Population')} AS Population
            FROM ({fx.GAZETTEER_RAW_SQL})""",
        "union_sources": raw + """SELECT HotelCode, CAST(NULL AS VARCHAR) AS cityCode, cityName,
            CASE WHEN CAST(HotelCode AS BIGINT) % 2 = 0 THEN Attractions END AS Attractions,
            CASE WHEN CAST(HotelCode AS BIGINT) % 2 = 0 THEN HotelFacilities END AS HotelFacilities FROM listings_raw""",
        "read_joined": O.with_base("SELECT HotelCode, facilities_keyword_hits, city_population FROM joined"),
        "read_catalogue": """SELECT s.source, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name
            FROM customer, (VALUES ('catalogue'), ('expanded'), ('text')) s(source)""",
        "peek": """SELECT 'row' AS kind, c_custkey || ',' || c_name AS value FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 5)
            UNION ALL SELECT 'line', 'c_custkey,c_name'
            UNION ALL SELECT 'line', c_custkey || ',' || c_name FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 2)""",
        "first_listings": raw + "SELECT HotelCode, HotelName, cityCode FROM listings_raw ORDER BY CAST(HotelCode AS BIGINT) LIMIT 7",
        "run_metrics": f"""WITH f AS ({LINEAR_FIXTURE}),
            m AS (SELECT run, sqrt(avg((y * scale - x1) * (y * scale - x1))) AS rmse, avg(abs(y * scale - x1)) AS mae, count(*) AS n
              FROM f, (VALUES ('half', CAST(0.5 AS DOUBLE)), ('third', CAST(0.33 AS DOUBLE)), ('none', CAST(0 AS DOUBLE))) r(run, scale) GROUP BY run)
            SELECT run, CAST(row_number() OVER (ORDER BY rmse, run) AS INTEGER) AS place, {O.rnd('rmse')} AS rmse, {O.rnd('mae')} AS mae, n FROM m""",
        "cleaning_job": O.with_base("SELECT HotelCode, hotel_star_rating, city_population FROM joined"),
        "train_job": O.with_base(f""", {rated}
            SELECT 'linear' AS model, total AS rows, total - {test} AS train_rows, {test} AS test_rows FROM s"""),
        "feature_bundle": O.with_base(f""", {rated}
            SELECT 'train' AS part, total - {test} AS rows, true AS same_features FROM s
            UNION ALL SELECT 'test', {test}, true FROM s"""),
        "named_coefficient": f"""WITH f AS ({LINEAR_FIXTURE})
            SELECT 'x1' AS feature, {O.rnd('regr_slope(y, x1)', 4)} AS coefficient FROM f""",
        "permutation_report": """SELECT f AS feature, CAST(400 AS BIGINT) AS n_permutations,
            'Coefficient for ' || f || ' equals 0' AS null_hypothesis
            FROM (VALUES ('city_population'), ('attractions_count')) v(f)""",
    }
