"""Composed jobs: the user entry points built from the operators."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from staysift.operators.enrich import attach_population, clean_gazetteer, clean_listings
from staysift.operators.lookup import iso_country_dim
from staysift.operators.schema import JOINED_TABLE_STEM, finalize_joined
from staysift.session import delete_path, scratch_path, spread


@dataclass
class CleanResult:
    """Cleaned listings and gazetteer; the joined table is planned on first
    access (planning it counts the gazetteer for the broadcast decision)."""

    listings: DataFrame
    gazetteer: DataFrame
    also_join: bool = True
    join_kwargs: dict = field(default_factory=dict)
    _joined: DataFrame | None = None

    @property
    def joined(self) -> DataFrame | None:
        if self.also_join and self._joined is None:
            self._joined = finalize_joined(attach_population(self.listings, self.gazetteer, **self.join_kwargs))
        return self._joined


def clean_and_join(
    listings_raw: DataFrame,
    gazetteer_raw: DataFrame,
    country_dim: DataFrame,
    also_join: bool = True,
    **join_kwargs,
) -> CleanResult:
    """Clean both sources and (optionally) attach city population.

    The result is lazy; nothing runs until a sink or an action.
    """
    listings = clean_listings(spread(listings_raw), country_dim)
    gazetteer = clean_gazetteer(gazetteer_raw, country_dim)
    return CleanResult(listings, gazetteer, also_join, dict(join_kwargs))


def run_cleaning(
    spark: SparkSession,
    listings_path: str,
    gazetteer_path: str,
    output_dir: str,
    listings_limit: int | None = None,
    gazetteer_limit: int | None = None,
    also_join: bool = True,
    output_format: str = "parquet",
    listings_encoding: str | None = None,
    gazetteer_encoding: str = "UTF-8",
    country_dim: DataFrame | None = None,
    multi_line: bool = True,
    malformed: str = "reject",
    max_rejected_share: float = 0.01,
) -> dict[str, str]:
    """Read both CSVs, clean, write ``hotels_clean``, ``world_cities_clean`` and
    (optionally) the joined table; returns the written paths.

    Rows whose fields do not fit the header are written to ``hotels_rejected`` and
    ``world_cities_rejected`` (where there are any) with the reason, and more than ``max_rejected_share`` of a source
    rejected is an error (``malformed="reject"``); they can be cut or padded (``"keep"``) or stop
    the scan at once (``"fail"``) instead. The cleaned gazetteer is written first and read back
    for the join, so the join plans from a materialised, counted table (no recomputation of
    the dedupe, lineage cut at a shared location). ``multi_line`` allows line breaks inside
    quoted values.
    """
    from staysift.sources.checked_csv import land_csv
    from staysift.sources.readers import gazetteer_columns, listing_columns, read_gazetteer_csv, read_listings_csv
    from staysift.sources.sinks import write_table

    dim = country_dim if country_dim is not None else iso_country_dim(spark)
    landings: list[str] = []
    rejected: dict[str, str] = {}

    def landed(path: str, name: str, encoding: str | None, limit: int | None) -> DataFrame:
        landing = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
        landings.append(landing)
        found = land_csv(spark, path, landing, encoding, multi_line, max_rejected_share, limit)
        if found.rejected_rows:
            rejected[name] = write_table(found.rejected, os.path.join(output_dir, name), output_format)
        return found.kept

    if malformed == "reject":
        world = gazetteer_columns(landed(gazetteer_path, "world_cities_rejected", gazetteer_encoding, gazetteer_limit))
        hotels = listing_columns(landed(listings_path, "hotels_rejected", listings_encoding, listings_limit))
    else:
        world = read_gazetteer_csv(spark, gazetteer_path, encoding=gazetteer_encoding, limit=gazetteer_limit)
        hotels = read_listings_csv(spark, listings_path, encoding=listings_encoding, limit=listings_limit,
                                   multi_line=multi_line, malformed=malformed)
    result = clean_and_join(hotels, world, dim, also_join=False)

    written: dict[str, str] = dict(rejected)
    written["hotels_clean"] = write_table(result.listings, os.path.join(output_dir, "hotels_clean"), output_format)
    written["world_cities_clean"] = write_table(
        result.gazetteer, os.path.join(output_dir, "world_cities_clean"), output_format
    )
    if also_join:
        if output_format == "parquet":
            listings = spark.read.parquet(written["hotels_clean"])
            gazetteer = spark.read.parquet(written["world_cities_clean"])
        else:  # text output loses types: join the cleaned frames themselves
            listings, gazetteer = result.listings, result.gazetteer
        joined = finalize_joined(attach_population(listings, gazetteer))
        written[JOINED_TABLE_STEM] = write_table(
            joined, os.path.join(output_dir, JOINED_TABLE_STEM), output_format
        )
    for landing in landings:
        delete_path(spark, landing)
    return written


# --- analysis jobs ---------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from staysift.functions import text as X  # noqa: E402
from staysift.functions.geo import lat_lon_loose  # noqa: E402
from staysift.operators import explore, lookup, profile, stats  # noqa: E402

RATING = "hotel_star_rating"
EDA_MEASURES = ("city_population", "attractions_count", "facilities_count", "facilities_keyword_hits", "hotel_latitude")
EDA_NUMERIC = (
    "hotel_star_rating", "city_population", "attractions_count", "facilities_count",
    "facilities_keyword_hits", "hotel_latitude", "hotel_longitude",
)


def profile_report(df: DataFrame, label: str = RATING, top_missing: int = 12, preview_rows: int = 5) -> dict[str, DataFrame]:
    """Data-quality profile: shape, missingness (top N), label counts incl.
    missing, and a preview."""
    return {
        "shape": profile.shape(df),
        "missing": profile.missing_profile(df, top=top_missing),
        "label_counts": profile.label_counts(df, label, include_missing=True),
        "preview": profile.preview(df, preview_rows),
    }


def eda_results(df: DataFrame, min_city_support: int = 10, k: int = 10) -> dict[str, DataFrame]:
    """The exploratory result tables (one lazy DataFrame each)."""
    regional = df.withColumn("sub_region", lookup.sub_region("countyName")).withColumn(
        "continent", lookup.continent("sub_region")
    )
    countries = explore.group_mean(df, "countyName", RATING).where("mean IS NOT NULL")
    cities = explore.group_mean_count(df, ["cityName", "countyName"], RATING).withColumn(
        "city_label", X.group_label("cityName", "countyName")
    )
    reliable = cities.where(f"count >= {min_city_support}")
    return {
        "label_counts": profile.label_counts(df, RATING),
        "means_by_rating": explore.means_by_label(df, RATING, EDA_MEASURES, ["hotel_longitude"]),
        "sub_region_means": explore.group_mean(regional, "sub_region", RATING),
        "continent_means": explore.group_mean(regional, "continent", RATING),
        "top_countries": explore.top_k(countries, "mean", k, False, ["countyName"]),
        "bottom_countries": explore.top_k(countries, "mean", k, True, ["countyName"]),
        "city_stats": cities,
        "top_cities": explore.top_k(reliable, "mean", k, False, ["cityName", "countyName"]),
        "bottom_cities": explore.top_k(reliable, "mean", k, True, ["cityName", "countyName"]),
        "map_points": explore.group_means(df, ["cityName", "countyName"], [RATING, "hotel_latitude", "hotel_longitude"]),
        "correlation": explore.correlation_matrix(df, EDA_NUMERIC),
    }


def expand_features(raw: DataFrame) -> DataFrame:
    """Expanded-analysis columns on the raw listing table: strict star label,
    raw facility token count, description length, attractions flag, loose
    coordinates."""
    lat, lon = lat_lon_loose("Map")
    return raw.withColumns(
        {
            RATING: X.strict_star_rating("HotelRating"),
            "facility_count": X.raw_token_count("HotelFacilities"),
            "description_length": X.text_length("Description"),
            "has_attractions": X.presence_flag("Attractions"),
            "attractions_label": X.flag_label(
                X.presence_flag("Attractions"), {0: "No Attractions Info", 1: "Has Attractions Info"}
            ),
            "latitude": lat,
            "longitude": lon,
        }
    )


def expanded_tests(df: DataFrame, feature: str = "facility_count", high_rating: int = 4) -> dict[str, DataFrame]:
    """Effect size, rank test, simple regression and diagnostics of a feature,
    high-rated (>= ``high_rating``) against the other rated listings, with the
    interpretation labels."""
    is_high = F.col(RATING) >= high_rating
    rated = df.where(F.col(RATING).isNotNull())
    d = stats.cohens_d(rated, feature, is_high)
    return {
        "effect_size": d.withColumn("interpretation", X.effect_size_label("cohens_d")),
        "mann_whitney": stats.mann_whitney(rated, feature, is_high).withColumn(
            "interpretation", X.p_value_label("p_value")
        ),
        "regression": stats.ols_simple(df, feature, RATING).withColumn("interpretation", X.p_value_label("p_value")),
        "diagnostics": profile.feature_diagnostics(df, feature),
        "box_by_rating": explore.box_summary(df, RATING, feature),
        "box_by_attractions": explore.box_summary(df, "attractions_label", RATING),
        "regression_band": stats.regression_band(df.where(F.col(RATING).isNotNull()), feature, RATING, ["HotelCode"]),
    }


def train_job(
    joined: DataFrame,
    out_dir: str,
    model: str = "rf",
    params: dict | None = None,
    sample: int | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    tune: bool = False,
    folds: int = 3,
    draws: int = 12,
) -> dict:
    """Train one model on the joined table and write model + metrics."""
    from staysift.operators import features, models, sampling
    from staysift.sources.sinks import save_model_run

    df = joined.dropna(subset=[RATING])
    if sample is not None:
        df = sampling.exact_sample(df, sample, ["HotelCode"], seed)
    fm = features.build_feature_matrices(df, ["HotelCode"], RATING, test_share, seed, True)
    run = models.train_regressor(fm.train, fm.test, model, params, tune, folds, draws, seed)
    extra = {
        "rows": fm.train.count() + fm.test.count(),
        "X_train_shape": [fm.train.count(), len(fm.prep.feature_names)],
        "X_test_shape": [fm.test.count(), len(fm.prep.feature_names)],
    }
    paths = save_model_run(joined.sparkSession, run, out_dir, extra)
    return {"paths": paths, "metrics": run.metrics, "best_params": run.best_params, **extra}


def permutation_report(
    joined: DataFrame,
    out_path: str,
    features_tested: tuple[str, ...] = ("city_population", "attractions_count"),
    n_permutations: int = 400,
    sample: int | None = None,
    test_share: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Permutation test of linear-regression coefficients on the training
    split; writes the report (one row per feature) as JSON and returns it."""
    from staysift.operators import features, permutation, sampling
    from staysift.sources.sinks import write_report

    df = joined.dropna(subset=[RATING])
    if sample is not None:
        df = sampling.exact_sample(df, sample, ["HotelCode"], seed)
    fm = features.build_feature_matrices(df, ["HotelCode"], RATING, test_share, seed, True)
    report = permutation.permutation_test(
        fm.train, ["HotelCode"], fm.prep.feature_names, list(features_tested), n_permutations, seed
    )
    write_report(report, out_path)
    return report
