"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, derives its inputs from the driver tables
(whole tables, whole texts) and returns a lazy DataFrame. The matching DuckDB
formulation lives in ``oracles.py`` under the same key.
"""

from __future__ import annotations

import hashlib
import math
import os
import random
import uuid
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import staysift.functions as X
from staysift.operators import enrich, explore, gram, lookup, models, permutation, profile, sampling, schema, stats
from staysift.operators import features as feat
from staysift.plans import fixtures as fx
from staysift.plans.jobs import clean_and_join
from staysift.session import scratch_path, spread
from staysift.sources import readers, sinks
from staysift.operators.bucketed import write_lookup
from staysift.streaming.enrich_stream import ATTRS, KEYS, enrich_stream, population_lookup, read_enriched

Query = Callable[[SparkSession, str], DataFrame]


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Round to a relative binary grid (same formula in the oracle).

    ``digits`` 6 keeps 30 significant bits (about 9 decimal digits): the value
    is scaled by 2^(bits - 1 - floor(log2|x|)), rounded half-up and scaled
    back, all exact IEEE steps in both engines. Exactly representable results
    stay bit-identical, and summation-order noise (~1e-13 relative) stays far
    below the grid, unlike a fixed decimal grid where a tie can fall between two
    engines' last-ulp differences.
    """
    c = F.col(c) if isinstance(c, str) else c
    bits = math.ceil(digits * math.log2(10)) + 10
    scale = F.pow(F.lit(2.0), F.lit(bits - 1) - F.floor(F.log2(F.abs(c))))
    special = (c == 0) | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(special, c).otherwise(F.floor(c * scale + 0.5) / scale)


def _cleaned(spark: SparkSession, sf_dir: str):
    return clean_and_join(
        fx.listings_raw(spark, sf_dir), fx.gazetteer_raw(spark, sf_dir), fx.country_dim(spark, sf_dir)
    )


def joined_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13-column joined listing table built from the driver tables."""
    return _cleaned(spark, sf_dir).joined


_CLEANING_SOURCES = ("functions/text.py", "functions/geo.py", "operators/schema.py", "operators/lookup.py",
                     "operators/enrich.py", "plans/fixtures.py", "plans/jobs.py", "plans/queries.py")


def _code_signature() -> str:
    """Hash of the code that produces the joined table, so a changed cleaning
    rule never reuses a table written by older code."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for rel in _CLEANING_SOURCES:
        with open(os.path.join(root, rel), "rb") as f:
            h.update(f.read())
    return h.hexdigest()[:12]


def _input_signature(spark: SparkSession, sf_dir: str, tables=("orders", "customer", "nation")) -> str:
    """Hash of the code and of the inputs' length and modification time, as the Hadoop
    file system that holds them reports it (a missing input is an error)."""
    parts = [sf_dir.rstrip("/"), _code_signature()]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = path.getFileSystem(conf)
        size = fs.getContentSummary(path).getLength()
        parts.append(f"{t}:{fs.getFileStatus(path).getModificationTime()}:{size}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def _is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a written table was committed (a half-written folder has no marker)."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def written_joined_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table as the cleaning job writes it: computed once per input
    set, written as Parquet under the shared checkpoint folder, then read back
    by every analysis query (as the exploratory notebooks read the written
    table). Reading cuts the cleaning lineage out of the analysis plans."""
    from staysift.session import scratch_path

    path = scratch_path(spark, f"joined-{_input_signature(spark, sf_dir)}")
    if not _is_complete(spark, path):
        joined_table(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --- cleaning -----------------------------------------------------------------


def q_canonical_headers(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    messy = {
        "countyCode": "\ufeffcountyCode",
        "countyName": " Country Name",
        "cityCode": "city_code ",
        "cityName": "CITYNAME",
        "HotelCode": "Hotel Code",
        "HotelName": "hotel_name",
        "HotelRating": "Hotel Rating",
        "Map": "map",
        "Attractions": "ï»¿attractions",
        "HotelFacilities": "HOTEL_FACILITIES",
        "Address": " Address ",
    }
    df = raw.toDF(*[messy[c] for c in raw.columns])
    # a second country column after renaming: the first one is kept
    df = df.withColumn("country", F.lit("dup"))
    out = schema.canonical_columns(df)
    out = schema.rename_aliases(out.withColumn("feature_count", X.raw_token_count("HotelFacilities")))
    return out.select(
        "countyCode", "countyName", "cityCode", "cityName", "HotelCode", "HotelName",
        "HotelRating", "Map", "Attractions", "HotelFacilities", "Address", "facilities_count",
    )


def q_star_label_parse(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    return raw.select(
        "HotelCode",
        "HotelRating",
        X.star_rating("HotelRating").alias("star_lenient"),
        X.strict_star_rating("HotelRating").alias("star_strict"),
    )


def q_lat_lon_parse(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    lat, lon = X.lat_lon("Map")
    lat2, lon2 = X.lat_lon_loose("Map")
    return raw.select(
        "HotelCode",
        rnd(lat).alias("lat"),
        rnd(lon).alias("lon"),
        rnd(lat2).alias("lat_loose"),
        rnd(lon2).alias("lon_loose"),
    )


def q_city_join_key(spark, sf_dir):
    docs = spread(fx.table(spark, sf_dir, "documents"))
    raw = fx.listings_raw(spark, sf_dir)
    a = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), X.city_join_key("text").alias("city_key"))
    b = raw.select(F.concat(F.lit("h"), F.col("HotelCode")).alias("id"), X.city_join_key("cityName").alias("city_key"))
    return a.unionByName(b)


def q_poi_count(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    return raw.select("HotelCode", X.attractions_count("Attractions").alias("attractions_count"))


def q_facility_tokens(spark, sf_dir):
    pages = spread(fx.table(spark, sf_dir, "pages"))
    raw = fx.listings_raw(spark, sf_dir)
    a = pages.select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        X.facility_token_count("html").alias("facility_tokens"),
        X.raw_token_count("html").alias("raw_tokens"),
    )
    b = raw.select(
        F.concat(F.lit("h"), F.col("HotelCode")).alias("id"),
        X.facility_token_count("HotelFacilities").alias("facility_tokens"),
        X.raw_token_count("HotelFacilities").alias("raw_tokens"),
    )
    return a.unionByName(b)


def q_keyword_hits(spark, sf_dir):
    docs = spread(fx.table(spark, sf_dir, "documents"))
    raw = fx.listings_raw(spark, sf_dir)
    a = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), X.keyword_hits("text").alias("hits"))
    b = raw.select(F.concat(F.lit("h"), F.col("HotelCode")).alias("id"), X.keyword_hits("HotelFacilities").alias("hits"))
    return a.unionByName(b)


def q_text_length_flag(spark, sf_dir):
    docs = spread(fx.table(spark, sf_dir, "documents"))
    labels = fx.table(spark, sf_dir, "labels")
    j = docs.join(labels, "doc_id", "left")
    return j.select(
        "doc_id",
        X.text_length("text").alias("description_length"),
        X.raw_token_count("text").alias("facility_count"),
        X.presence_flag("quality").alias("has_label"),
        X.flag_label(X.presence_flag("quality"), {0: "No Label Info", 1: "Has Label Info"}).alias("label_text"),
    )


def q_country_lookup(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    dim = fx.country_dim(spark, sf_dir)
    out = lookup.iso2_lookup(raw, "countyCode", "countyName", "country_iso2", dim)
    out = lookup.iso2_lookup(out, "countyCode", None, "iso2_from_code", dim)
    out = lookup.iso2_lookup(out, None, "countyName", "iso2_from_name", dim)
    return out.select("HotelCode", X.tidy_code("countyCode").alias("code_tidy"), "country_iso2", "iso2_from_code", "iso2_from_name")


def q_dedupe_keep_max(spark, sf_dir):
    g = _cleaned(spark, sf_dir).gazetteer
    return g.select("country_iso2", "city_join_key", "City", "Country", "Population")


def q_null_safe_left_join(spark, sf_dir):
    j = joined_table(spark, sf_dir)
    return j.withColumn("hotel_latitude", rnd("hotel_latitude")).withColumn("hotel_longitude", rnd("hotel_longitude"))


def q_null_safe_left_join_shuffled(spark, sf_dir):
    """Same join through the salted shuffle path (broadcast disabled)."""
    r = _cleaned(spark, sf_dir)
    joined = schema.finalize_joined(
        enrich.attach_population(r.listings, r.gazetteer, broadcast_max_rows=-1, salt_buckets=8)
    )
    return joined.select("HotelCode", "city_population")


def q_join_coverage(spark, sf_dir):
    j = joined_table(spark, sf_dir)
    return enrich.join_coverage(j, "city_population").select(
        "rows", "unmatched", rnd("unmatched_share").alias("unmatched_share")
    )


def q_unmatched_keys(spark, sf_dir):
    r = _cleaned(spark, sf_dir)
    return enrich.unmatched_keys(r.listings, r.gazetteer, ["country_iso2", "city_join_key"])


REGISTRY: dict[str, Query] = {
    "canonical_headers": q_canonical_headers,
    "star_label_parse": q_star_label_parse,
    "lat_lon_parse": q_lat_lon_parse,
    "city_join_key": q_city_join_key,
    "poi_count": q_poi_count,
    "facility_tokens": q_facility_tokens,
    "keyword_hits": q_keyword_hits,
    "text_length_flag": q_text_length_flag,
    "country_lookup": q_country_lookup,
    "dedupe_keep_max": q_dedupe_keep_max,
    "null_safe_left_join": q_null_safe_left_join,
    "null_safe_left_join_shuffled": q_null_safe_left_join_shuffled,
    "join_coverage": q_join_coverage,
    "unmatched_keys": q_unmatched_keys,
}


# --- profile / explore ----------------------------------------------------------


MEASURES = ["city_population", "attractions_count", "facilities_count", "facilities_keyword_hits", "hotel_latitude"]
NUMERIC = [
    "hotel_star_rating", "city_population", "attractions_count", "facilities_count",
    "facilities_keyword_hits", "hotel_latitude", "hotel_longitude",
]


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: rnd(c) for c in cols})


def q_label_counts(spark, sf_dir):
    return profile.label_counts(written_joined_table(spark, sf_dir), "hotel_star_rating")


def q_label_counts_with_null(spark, sf_dir):
    return profile.label_counts(written_joined_table(spark, sf_dir), "hotel_star_rating", include_missing=True)


def q_mean_by_label(spark, sf_dir):
    out = explore.means_by_label(written_joined_table(spark, sf_dir), "hotel_star_rating", MEASURES, ["hotel_longitude"])
    return _round_cols(out, [c for c in out.columns if c.startswith("mean")])


def q_region_rollup(spark, sf_dir):
    j = written_joined_table(spark, sf_dir)
    j = j.withColumn("sub_region", lookup.sub_region("countyName"))
    j = j.withColumn("continent", lookup.continent("sub_region"))
    a = explore.group_mean(j, "sub_region", "hotel_star_rating").select(
        F.lit("sub_region").alias("level"), F.col("sub_region").alias("grp"), "mean")
    b = explore.group_mean(j, "continent", "hotel_star_rating").select(
        F.lit("continent").alias("level"), F.col("continent").alias("grp"), "mean")
    return _round_cols(a.unionByName(b), ["mean"])


def _country_means(spark, sf_dir):
    j = written_joined_table(spark, sf_dir)
    return explore.group_mean(j, "countyName", "hotel_star_rating").where(F.col("mean").isNotNull())


def q_top_countries(spark, sf_dir):
    return _round_cols(explore.top_k(_country_means(spark, sf_dir), "mean", 10, False, ["countyName"]), ["mean"])


def q_bottom_countries(spark, sf_dir):
    return _round_cols(explore.top_k(_country_means(spark, sf_dir), "mean", 10, True, ["countyName"]), ["mean"])


def _city_stats(spark, sf_dir, min_count=None):
    j = written_joined_table(spark, sf_dir)
    out = explore.group_mean_count(j, ["cityName", "countyName"], "hotel_star_rating", min_count)
    return out.withColumn("city_label", X.group_label("cityName", "countyName"))


def q_city_stats(spark, sf_dir):
    return _round_cols(_city_stats(spark, sf_dir), ["mean"])


def q_top_cities(spark, sf_dir):
    top = explore.top_k(_city_stats(spark, sf_dir, 10), "mean", 10, False, ["cityName", "countyName"])
    return _round_cols(top, ["mean"])


def q_bottom_cities(spark, sf_dir):
    bottom = explore.top_k(_city_stats(spark, sf_dir, 10), "mean", 10, True, ["cityName", "countyName"])
    return _round_cols(bottom, ["mean"])


def q_map_points(spark, sf_dir):
    j = written_joined_table(spark, sf_dir)
    out = explore.group_means(j, ["cityName", "countyName"], ["hotel_star_rating", "hotel_latitude", "hotel_longitude"])
    return _round_cols(out, ["hotel_star_rating", "hotel_latitude", "hotel_longitude"])


def q_missing_profile(spark, sf_dir):
    return _round_cols(profile.missing_profile(written_joined_table(spark, sf_dir), top=12), ["missing_pct"])


def q_shape(spark, sf_dir):
    return profile.shape(written_joined_table(spark, sf_dir))


def q_correlation_matrix(spark, sf_dir):
    return _round_cols(explore.correlation_matrix(written_joined_table(spark, sf_dir), NUMERIC), ["corr"])


def q_feature_diagnostics(spark, sf_dir):
    j = written_joined_table(spark, sf_dir)
    parts = []
    for c in ["city_population", "facilities_count", "attractions_count"]:
        parts.append(profile.feature_diagnostics(j, c).select(F.lit(c).alias("feature"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _round_cols(out, ["skewness"])


def q_box_summary(spark, sf_dir):
    out = explore.box_summary(written_joined_table(spark, sf_dir), "hotel_star_rating", "facilities_count")
    return _round_cols(out, ["q1", "median", "q3", "whisker_low", "whisker_high"])


def q_box_summary_lineitem(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    out = explore.box_summary(li, "l_returnflag", "l_extendedprice")
    return _round_cols(out, ["q1", "median", "q3", "whisker_low", "whisker_high"])


def q_cohens_d(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    labels = fx.table(spark, sf_dir, "labels")
    j = docs.join(labels, "doc_id", "inner").withColumn("description_length", X.text_length("text"))
    out = stats.cohens_d(j, "description_length", F.col("quality") == 1)
    out = out.withColumn("effect_size", X.effect_size_label("cohens_d"))
    return _round_cols(out, ["mean_high", "mean_low", "var_high", "var_low", "cohens_d"])


def q_mann_whitney(spark, sf_dir):
    """Values of click events against those of all other events."""
    out = stats.mann_whitney(fx.table(spark, sf_dir, "events"), "value", F.col("event_type") == "click")
    out = out.withColumn("interpretation", X.p_value_label("p_value"))
    return _round_cols(
        out.select("n_high", "n_low", "u_statistic", "z", "p_value", "interpretation"), ["u_statistic", "z", "p_value"])


def q_mann_whitney_small(spark, sf_dir):
    """Mean order prices of one market segment against the others', one value for each segment and
    order priority: five values against twenty, so the exact distribution of U."""
    customers = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = fx.table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    means = orders.join(customers, "o_custkey").groupBy("c_mktsegment", "o_orderpriority").agg(F.avg("o_totalprice").alias("mean"))
    parts = []
    for segment in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"):
        m = stats.mann_whitney(means, "mean", F.col("c_mktsegment") == segment)
        parts.append(m.select(F.lit(segment).alias("segment"), "n_high", "n_low", "u_statistic", "p_value", "exact"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return _round_cols(out, ["u_statistic", "p_value"])


def q_ols_simple(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    out = stats.ols_simple(li, "l_quantity", "l_extendedprice")
    return _round_cols(out.select("n", "coefficient", "intercept", "r_squared", "t"),
                       ["coefficient", "intercept", "r_squared", "t"])


def q_regplot_band(spark, sf_dir):
    j = written_joined_table(spark, sf_dir).where(F.col("hotel_star_rating").isNotNull())
    out = stats.regression_band(j, "facilities_count", "hotel_star_rating", ["HotelCode"], n_boot=1000, grid=100)
    return _round_cols(out, ["x", "fit", "band_low", "band_high"])


REGISTRY.update({
    "label_counts": q_label_counts,
    "label_counts_with_null": q_label_counts_with_null,
    "mean_by_label": q_mean_by_label,
    "region_rollup": q_region_rollup,
    "top_countries": q_top_countries,
    "bottom_countries": q_bottom_countries,
    "city_stats": q_city_stats,
    "top_cities": q_top_cities,
    "bottom_cities": q_bottom_cities,
    "map_points": q_map_points,
    "missing_profile": q_missing_profile,
    "shape": q_shape,
    "correlation_matrix": q_correlation_matrix,
    "feature_diagnostics": q_feature_diagnostics,
    "box_summary": q_box_summary,
    "box_summary_lineitem": q_box_summary_lineitem,
    "cohens_d": q_cohens_d,
    "mann_whitney": q_mann_whitney,
    "mann_whitney_small": q_mann_whitney_small,
    "ols_simple": q_ols_simple,
    "regplot_band": q_regplot_band,
})


# --- sampling, features, models, permutation -------------------------------------



IMPUTE_FIXTURE = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS cust_mod,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 7.0 END AS constant
FROM orders
"""

LINEAR_FIXTURE = """
SELECT l_orderkey, l_linenumber, l_extendedprice / 1000.0 AS y, l_quantity AS x1, l_discount * 100.0 AS x2,
  l_returnflag
FROM lineitem
"""

PERM_FIXTURE = """
SELECT o_orderkey, o_totalprice / 1000.0 AS y, CAST(o_custkey % 97 AS DOUBLE) AS f1,
  CAST(o_orderkey % 13 AS DOUBLE) AS f2
FROM orders
"""


def _sql_fixture(spark, sf_dir, sql, tables):
    fx.register_tables(spark, sf_dir, tables)
    return spark.sql(sql)


def q_exact_sample(spark, sf_dir):
    cust = fx.table(spark, sf_dir, "customer")
    return sampling.exact_sample(cust, 500, ["c_custkey"], seed=42).select("c_custkey", "c_mktsegment")


def q_stratified_split(spark, sf_dir):
    cust = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return sampling.with_split_flag(cust, ["c_custkey"], "c_mktsegment", 0.2, 42, True)


def q_impute_scale(spark, sf_dir):
    df = _sql_fixture(spark, sf_dir, IMPUTE_FIXTURE, ("orders",))
    cols = ["price", "cust_mod", "constant"]
    medians, means, scales = feat.fit_numeric(df, cols)
    rows = [(c, medians[c], means[c], scales[c]) for c in cols]
    fitted = spark.createDataFrame(rows, "feature string, median double, mean double, scale double")
    return _round_cols(fitted, ["median", "mean", "scale"])


def q_capped_one_hot(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    spec = feat.fit_categorical(part, "p_brand", 8)
    prep = feat.FeaturePrep([], {}, {}, {}, [spec])
    out = prep.transform(part)
    names = F.array(*[F.lit(n) for n in prep.feature_names])
    pos = F.array_position(vector_to_array("features"), 1.0)
    return out.select("p_partkey", F.when(pos > 0, F.element_at(names, pos.cast("int"))).alias("slot"))


def q_regression_metrics(spark, sf_dir):
    df = _sql_fixture(spark, sf_dir, LINEAR_FIXTURE, ("lineitem",))
    scored = df.select(F.col("x1").alias("label"), (F.col("y") / 1.5).alias("prediction"), "l_returnflag")
    m = models.regression_metrics(scored)
    return _round_cols(m, ["rmse", "mae", "r2", "within_0_5", "within_1_0"])


def q_metrics_by_bucket(spark, sf_dir):
    df = _sql_fixture(spark, sf_dir, LINEAR_FIXTURE, ("lineitem",))
    scored = df.select(F.col("x1").alias("label"), (F.col("y") / 1.5).alias("prediction"), "l_returnflag")
    m = models.metrics_by_bucket(scored, "l_returnflag")
    return _round_cols(m, ["rmse", "mae", "within_0_5", "within_1_0"])


def _linear_data(spark, sf_dir):
    df = _sql_fixture(spark, sf_dir, LINEAR_FIXTURE, ("lineitem",))
    return VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df).withColumnRenamed("y", "label")


def _coef_frame(spark, model):
    rows = [("intercept", float(model.intercept))] + [
        (n, float(v)) for n, v in zip(["x1", "x2"], model.coefficients.toArray())
    ]
    return spark.createDataFrame(rows, "term string, estimate double")


def q_linear_fit(spark, sf_dir):
    data = _linear_data(spark, sf_dir)
    model = models.linear().setSolver("normal").fit(data)
    return _coef_frame(spark, model).withColumn("estimate", rnd("estimate", 4))


def q_ridge_fit(spark, sf_dir):
    data = _linear_data(spark, sf_dir)
    sd, n = models.label_scale(data)
    model = models.ridge(10.0, sd, n).fit(data)
    return _coef_frame(spark, model).withColumn("estimate", rnd("estimate", 4))


def q_lasso_fit(spark, sf_dir):
    data = _linear_data(spark, sf_dir)
    model = models.lasso(0.001).fit(data)
    return _coef_frame(spark, model).withColumn("estimate", rnd("estimate", 3))


def _matrices(spark, sf_dir):
    j = written_joined_table(spark, sf_dir).dropna(subset=["hotel_star_rating"])
    # the input is a scan of the written table: no extra checkpoint needed
    return feat.build_feature_matrices(j, ["HotelCode"], "hotel_star_rating", 0.2, 42, True, materialize_input=False)


def q_feature_matrix(spark, sf_dir):
    fm = _matrices(spark, sf_dir)
    width = len(fm.prep.feature_names)
    t = fm.train.select(F.lit("train").alias("split"), "label", "features")
    s = fm.test.select(F.lit("test").alias("split"), "label", "features")
    both = t.unionByName(s)
    return both.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.lit(width).cast("bigint").alias("width"),
        rnd(F.avg("label")).alias("mean_label"),
    )


def _run(spark, sf_dir, name, params=None, tune=False, draws=4):
    fm = _matrices(spark, sf_dir)
    train, test = fm.train, fm.test
    return models.train_regressor(train, test, name, params, tune, folds=3, draws=draws, seed=42, keys=["HotelCode"]), fm


def _metrics_frame(spark, run):
    m = run.metrics
    rows = [(run.model_name, run.tuned, float(m["rmse"]), float(m["mae"]), float(m["r2"]),
             float(m["within_0_5"]), float(m["within_1_0"]), int(m["n"]), str(run.best_params))]
    return spark.createDataFrame(
        rows, "model string, tuned boolean, rmse double, mae double, r2 double, within_0_5 double, "
        "within_1_0 double, n bigint, best_params string")


def q_forest_fit(spark, sf_dir):
    run, _ = _run(spark, sf_dir, "rf", {"n_estimators": 100, "max_depth": 20})
    return _metrics_frame(spark, run)


def q_boosted_fit(spark, sf_dir):
    run, _ = _run(spark, sf_dir, "xgb", {"n_estimators": 300, "max_depth": 8, "learning_rate": 0.05})
    return _metrics_frame(spark, run)


def q_listing_tuned_ridge(spark, sf_dir):
    run, _ = _run(spark, sf_dir, "ridge", tune=True)
    return _metrics_frame(spark, run)


def q_listing_random_search(spark, sf_dir):
    run, _ = _run(spark, sf_dir, "lasso", tune=True, draws=12)
    return _metrics_frame(spark, run)


def q_tuned_ridge(spark, sf_dir):
    """Every penalty's error on every held-out fold, and the chosen one, from one pass."""
    found = models.tune_penalty(_linear_data(spark, sf_dir), "ridge", ["l_orderkey", "l_linenumber"])
    rows = [(a, f, e, r, a == found.alpha) for a, f, e, r in found.rows]
    out = spark.createDataFrame(rows, "alpha double, fold int, rmse double, r2 double, chosen boolean")
    return _round_cols(out, ["alpha", "rmse", "r2"])


def q_random_search(spark, sf_dir):
    """Twelve drawn lasso penalties: mean error over the folds, the coefficients of all
    rows along the path, and the chosen penalty, from one pass."""
    grams = gram.fold_grams(_linear_data(spark, sf_dir), ["l_orderkey", "l_linenumber"])
    drawn = random.Random(42).sample(models.LASSO_SEARCH_ALPHAS, 12)
    found = gram.search_penalty(grams, drawn, "lasso")
    mean = found.mean_rmse()
    path = gram.lasso_path(grams.sum(axis=0), drawn)
    rows = [(a, mean[a], float(b), float(w[0]), float(w[1]), a == found.alpha) for a, (b, w) in zip(drawn, path, strict=True)]
    out = spark.createDataFrame(rows, "alpha double, rmse double, intercept double, x1 double, x2 double, chosen boolean")
    return _round_cols(out, ["alpha", "rmse", "intercept", "x1", "x2"])


def q_model_comparison(spark, sf_dir):
    fm = _matrices(spark, sf_dir)
    train, test = fm.train, fm.test
    runs = [
        models.train_regressor(train, test, "linear"),
        models.train_regressor(train, test, "ridge", {"alpha": 10.0}),
        models.train_regressor(train, test, "lasso", {"alpha": 0.001}),
        models.train_regressor(train, test, "rf", {"n_estimators": 20, "max_depth": 8}),
    ]
    return models.compare_runs(spark, runs)


def q_feature_importance(spark, sf_dir):
    run, fm = _run(spark, sf_dir, "rf", {"n_estimators": 20, "max_depth": 8})
    return models.feature_importance(run.model, fm.prep.feature_names, spark)


def q_permutation_test(spark, sf_dir):
    df = _sql_fixture(spark, sf_dir, PERM_FIXTURE, ("orders",))
    data = VectorAssembler(inputCols=["f1", "f2"], outputCol="features").transform(df).withColumnRenamed("y", "label")
    out = permutation.permutation_test(data, ["o_orderkey"], ["f1", "f2"], ["f1", "f2"], n_permutations=400, seed=42)
    out = out.select("feature", "observed_coefficient", "empirical_p_value_two_sided", "null_mean", "null_std",
                     "n_permutations")
    return _round_cols(out, ["observed_coefficient", "empirical_p_value_two_sided", "null_mean", "null_std"])


def q_listing_permutation_test(spark, sf_dir):
    fm = _matrices(spark, sf_dir)
    out = permutation.permutation_test(
        fm.train, ["HotelCode"], fm.prep.feature_names, ["city_population", "attractions_count"],
        n_permutations=400, seed=42,
    )
    return out.select("feature", "observed_coefficient", "empirical_p_value_two_sided", "null_mean", "null_std")


REGISTRY.update({
    "exact_sample": q_exact_sample,
    "stratified_split": q_stratified_split,
    "impute_scale": q_impute_scale,
    "capped_one_hot": q_capped_one_hot,
    "regression_metrics": q_regression_metrics,
    "metrics_by_bucket": q_metrics_by_bucket,
    "linear_fit": q_linear_fit,
    "ridge_fit": q_ridge_fit,
    "lasso_fit": q_lasso_fit,
    "feature_matrix": q_feature_matrix,
    "forest_fit": q_forest_fit,
    "boosted_fit": q_boosted_fit,
    "tuned_ridge": q_tuned_ridge,
    "random_search": q_random_search,
    "listing_tuned_ridge": q_listing_tuned_ridge,
    "listing_random_search": q_listing_random_search,
    "model_comparison": q_model_comparison,
    "feature_importance": q_feature_importance,
    "permutation_test": q_permutation_test,
    "listing_permutation_test": q_listing_permutation_test,
})


# --- sources, sinks, streaming, expanded analysis --------------------------------




def _fresh_dir(spark, tag: str) -> str:
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


def q_csv_roundtrip(spark, sf_dir):
    """Write the raw listings as CSV, read them back through the messy-CSV reader."""
    path = _fresh_dir(spark, "csv")
    sinks.write_table(fx.listings_raw(spark, sf_dir), path, "csv")
    return readers.read_listings_csv(spark, path, columns="all")


LANDED_FILE_ROWS = 500_000


def _landed_stream(spark, sf_dir, start):
    """Two files land and are processed, one per micro-batch; then two more land and the
    query is started again from its checkpoint. Many listings land in more files, of bounded
    rows, still in two micro-batches. ``start`` gets the landing folder, the listings' schema, the
    country names, the output and checkpoint folders and the files of a micro-batch."""
    base = _fresh_dir(spark, "stream")
    landing, out, ckpt = (os.path.join(base, d) for d in ("landing", "out", "ckpt"))
    raw = fx.listings_raw(spark, sf_dir)
    files = max(1, -(-fx.table(spark, sf_dir, "orders").count() // (4 * LANDED_FILE_ROWS)))  # of a micro-batch
    half = F.col("HotelCode").cast("bigint") % 2 == 0
    dim = fx.country_dim(spark, sf_dir)
    for part in (raw.where(half), raw.where(~half)):
        sinks.write_table(part.repartition(2 * files), landing, "parquet", mode="append")
        start(landing, raw.schema, dim, out, ckpt, files).awaitTermination()
    return q_null_safe_left_join_from(read_enriched(spark, out))


def q_stream_enrich(spark, sf_dir):
    """The cleaning + enrichment join run as a stream over landed files."""
    gazetteer = enrich.clean_gazetteer(fx.gazetteer_raw(spark, sf_dir), fx.country_dim(spark, sf_dir))
    return _landed_stream(spark, sf_dir, lambda landing, schema, dim, out, ckpt, files: enrich_stream(
        spark, landing, schema, gazetteer, dim, out, ckpt, max_files_per_trigger=files))


def q_stream_enrich_large(spark, sf_dir):
    """The same stream against a lookup that is not broadcast: written once in buckets, joined
    batch by batch, with frequent keys carried from batch to batch and over the restart."""
    gazetteer = enrich.clean_gazetteer(fx.gazetteer_raw(spark, sf_dir), fx.country_dim(spark, sf_dir))
    lookup = write_lookup(population_lookup(gazetteer), KEYS, ATTRS, _fresh_dir(spark, "lookup"))
    return _landed_stream(spark, sf_dir, lambda landing, schema, dim, out, ckpt, files: enrich_stream(
        spark, landing, schema, None, dim, out, ckpt, max_files_per_trigger=files, lookup=lookup))


def q_null_safe_left_join_from(df):
    return df.withColumn("hotel_latitude", rnd("hotel_latitude")).withColumn("hotel_longitude", rnd("hotel_longitude"))


def q_expanded_features(spark, sf_dir):
    """Expanded-analysis features on the raw listings: strict stars, raw token
    count, description length, presence flag, loose coordinates."""
    raw = fx.listings_raw(spark, sf_dir)
    lat, lon = X.lat_lon_loose("Map")
    return raw.select(
        "HotelCode",
        X.strict_star_rating("HotelRating").alias("hotel_star_rating"),
        X.raw_token_count("HotelFacilities").alias("facility_count"),
        X.text_length("Attractions").alias("description_length"),
        X.presence_flag("Attractions").alias("has_attractions"),
        X.flag_label(X.presence_flag("Attractions"), {0: "No Attractions Info", 1: "Has Attractions Info"}).alias(
            "attractions_label"),
        rnd(lat).alias("latitude"),
        rnd(lon).alias("longitude"),
    )


def q_expanded_tests(spark, sf_dir):
    """All tests of facility count: effect size and rank test, high-rated (4 and up)
    against the other rated listings and attractions info against none, and the simple
    regression of the rating; each with its p-value (none for effect sizes) and label."""
    e = q_expanded_features(spark, sf_dir)
    rated = e.where(F.col("hotel_star_rating").isNotNull())
    null = F.lit(None).cast("double")
    parts = []
    for split, df, high in (
        ("rating", rated, F.col("hotel_star_rating") >= 4),
        ("attractions", e, F.col("has_attractions") == 1),
    ):
        d = stats.cohens_d(df, "facility_count", high)
        parts.append(d.select(
            F.lit("cohens_d").alias("test"), F.lit(split).alias("split"), rnd("cohens_d").alias("statistic"),
            null.alias("p_value"), X.effect_size_label("cohens_d").alias("interpretation")))
        m = stats.mann_whitney(df, "facility_count", high)
        parts.append(m.select(
            F.lit("mann_whitney"), F.lit(split), rnd("u_statistic"), rnd("p_value"), X.p_value_label("p_value")))
    o = stats.ols_simple(e, "facility_count", "hotel_star_rating")
    parts.append(o.select(
        F.lit("ols"), F.lit("rating"), rnd("coefficient"), rnd("p_value"), X.p_value_label("p_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def q_ols_p_value(spark, sf_dir):
    """Simple regressions with weak slopes: t, p-value and label."""
    li = fx.table(spark, sf_dir, "lineitem")
    parts = []
    for x, y in (("l_tax", "l_discount"), ("l_linenumber", "l_quantity")):
        o = stats.ols_simple(li, x, y)
        parts.append(o.select(F.lit(x).alias("feature"), "n", rnd("t").alias("t"), rnd("p_value").alias("p_value"),
                              X.p_value_label("p_value").alias("interpretation")))
    return parts[0].union(parts[1])


REGISTRY["ols_p_value"] = q_ols_p_value
REGISTRY.update({
    "csv_roundtrip": q_csv_roundtrip,
    "stream_enrich": q_stream_enrich,
    "stream_enrich_large": q_stream_enrich_large,
    "expanded_features": q_expanded_features,
    "expanded_tests": q_expanded_tests,
})


from staysift.plans import io_queries  # noqa: E402

REGISTRY.update(io_queries.REGISTRY)
