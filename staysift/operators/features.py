"""Leak-free feature matrix: fitted on train only, applied to any split.

* numeric: exact median imputation, then centring and scaling by the
  population standard deviation (a zero sd scales by 1);
* categorical: string cast with a ``__MISSING__`` sentinel, one-hot with a level
  cap (at most ``cap - 1`` most frequent levels kept and the rest pooled into one
  ``infrequent`` slot when there are more than ``cap`` levels); a level never
  seen in training encodes as all zeros.

Fitting runs a handful of aggregations; the fitted state is a few hundred
constants (medians, moments, kept levels), so applying it is a single
projection plus a one-hot encoder, with no join for the kept levels.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staysift.operators.explore import exact_quantiles
from staysift.operators.lookup import checked_broadcast
from staysift.operators.schema import missing_sentinel

ROWS_PER_TASK = 100_000  # of the matrices
MISSING = "__MISSING__"
INFREQUENT = "infrequent"

# --- fixed values: must equal the source project's for the same results --------
NUMERIC_FEATURES: tuple[str, ...] = (
    "city_population",
    "hotel_latitude",
    "hotel_longitude",
    "attractions_count",
    "facilities_count",
    "facilities_keyword_hits",
)
CATEGORICAL_CAPS: tuple[tuple[str, int], ...] = (("countyCode", 250), ("cityCode", 120), ("cityName", 80))
IDENTIFIER_COLUMNS: tuple[str, ...] = ("HotelCode", "HotelName")
TARGET = "hotel_star_rating"
# --- end of fixed values -----------------------------------------------------------


@dataclass
class CategoricalSpec:
    column: str
    cap: int
    kept: list[str]
    pooled: bool
    train_levels: DataFrame | None = None  # all training levels, only when pooled

    def size(self) -> int:
        return len(self.kept) + (1 if self.pooled else 0)

    def names(self) -> list[str]:
        out = [f"{self.column}_{lvl}" for lvl in self.kept]
        return out + ([f"{self.column}_{INFREQUENT}"] if self.pooled else [])


@dataclass
class FeaturePrep:
    numeric: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    categorical: list[CategoricalSpec] = field(default_factory=list)
    output_col: str = "features"
    _encoders: dict = field(default_factory=dict, repr=False, compare=False)

    @property
    def feature_names(self) -> list[str]:
        names = list(self.numeric)
        for c in self.categorical:
            names += c.names()
        return names

    def transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        out = missing_sentinel(df, [c.column for c in self.categorical], MISSING)
        scaled = {}
        for c in self.numeric:
            filled = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            scaled[f"__num_{c}"] = (filled - F.lit(self.means[c])) / F.lit(self.scales[c])
        out = out.withColumns(scaled)
        vec_inputs = [f"__num_{c}" for c in self.numeric]
        for spec in self.categorical:
            idx_col, vec_col = f"__idx_{spec.column}", f"__ohe_{spec.column}"
            unknown = float(spec.size())  # dropped slot -> all zeros
            pairs = []
            for i, lvl in enumerate(spec.kept):
                pairs += [F.lit(lvl), F.lit(float(i))]
            kept_idx = F.try_element_at(F.create_map(*pairs), F.col(spec.column)) if pairs else F.lit(None)
            if spec.pooled:
                levels = checked_broadcast(spec.train_levels.withColumnRenamed("level", "__lvl"))
                out = out.join(levels, out[spec.column] == levels["__lvl"], "left")
                pooled = F.when(F.col("__lvl").isNotNull(), F.lit(float(len(spec.kept))))
                out = out.withColumn(idx_col, F.coalesce(kept_idx, pooled, F.lit(unknown))).drop("__lvl")
            else:
                out = out.withColumn(idx_col, F.coalesce(kept_idx, F.lit(unknown)))
            key = (idx_col, vec_col, spec.size() + 1)
            if key not in self._encoders:  # fitted once, reused for every split
                self._encoders[key] = _encoder(spark, *key)
            out = self._encoders[key].transform(out)
            vec_inputs.append(vec_col)
        assembled = VectorAssembler(inputCols=vec_inputs, outputCol=self.output_col).transform(out)
        drop = [c for c in assembled.columns if c.startswith("__num_") or c.startswith("__idx_") or c.startswith("__ohe_")]
        return assembled.drop(*drop)

    def to_json(self) -> str:
        return json.dumps(
            {
                "numeric": self.numeric,
                "medians": self.medians,
                "means": self.means,
                "scales": self.scales,
                "categorical": [
                    {"column": c.column, "cap": c.cap, "kept": c.kept, "pooled": c.pooled} for c in self.categorical
                ],
                "feature_names": self.feature_names,
            }
        )


def save_feature_prep(prep: FeaturePrep, spark: SparkSession, path: str) -> str:
    """Persist the fitted constants (JSON) and, for pooled categoricals, the
    training levels (Parquet) under ``path``."""
    import os

    spark.createDataFrame([(prep.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "prep")
    )
    for spec in prep.categorical:
        if spec.pooled and spec.train_levels is not None:
            spec.train_levels.write.mode("overwrite").parquet(os.path.join(path, f"levels_{spec.column}"))
    return path


def load_feature_prep(spark: SparkSession, path: str) -> FeaturePrep:
    """Inverse of ``save_feature_prep``."""
    import os

    doc = json.loads(spark.read.text(os.path.join(path, "prep")).first().value)
    specs = []
    for c in doc["categorical"]:
        levels = spark.read.parquet(os.path.join(path, f"levels_{c['column']}")) if c["pooled"] else None
        specs.append(CategoricalSpec(c["column"], c["cap"], list(c["kept"]), c["pooled"], levels))
    return FeaturePrep(list(doc["numeric"]), doc["medians"], doc["means"], doc["scales"], specs)


def _encoder(spark: SparkSession, idx_col: str, vec_col: str, size: int) -> OneHotEncoderModel:
    """One-hot encoder of a known width; the last slot (unknown) is dropped."""
    fit_on = spark.range(size).select(F.col("id").cast("double").alias(idx_col))
    return OneHotEncoder(inputCols=[idx_col], outputCols=[vec_col], dropLast=True, handleInvalid="error").fit(fit_on)


def fit_numeric(train: DataFrame, columns: Sequence[str]) -> tuple[dict, dict, dict]:
    """Exact medians, then mean and population sd of the imputed columns."""
    cols = list(columns)
    long = train.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("r")
    ).select("r.*")
    med_rows = exact_quantiles(long, ["feature"], "v", [0.5]).collect()  # one row per feature
    medians = {c: 0.0 for c in cols}
    for r in med_rows:
        medians[r.feature] = float(r.quantile) if r.quantile is not None else 0.0
    aggs = []
    for c in cols:
        filled = F.coalesce(F.col(c).cast("double"), F.lit(medians[c]))
        aggs += [F.avg(filled).alias(f"m_{c}"), F.stddev_pop(filled).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    means = {c: float(row[f"m_{c}"] or 0.0) for c in cols}
    scales = {c: (float(row[f"s_{c}"]) if row[f"s_{c}"] else 1.0) for c in cols}
    return medians, means, scales


def fit_categorical(train: DataFrame, column: str, cap: int) -> CategoricalSpec:
    """Level counts on train; keep all when there are at most ``cap`` levels,
    else the ``cap - 1`` most frequent (ties by level) and pool the rest."""
    counts = missing_sentinel(train.select(column), [column], MISSING).groupBy(column).count()
    top = counts.orderBy(F.desc("count"), F.asc(column)).limit(cap + 1).collect()  # bounded by cap
    if len(top) <= cap:
        return CategoricalSpec(column, cap, sorted(r[column] for r in top), pooled=False)
    kept = sorted(r[column] for r in top[: cap - 1])
    levels = counts.select(F.col(column).alias("level"))
    return CategoricalSpec(column, cap, kept, pooled=True, train_levels=levels)


def fit_feature_prep(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[tuple[str, int]] = CATEGORICAL_CAPS,
) -> FeaturePrep:
    num = [c for c in numeric if c in train.columns]
    medians, means, scales = fit_numeric(train, num)
    specs = [fit_categorical(train, c, cap) for c, cap in categorical if c in train.columns]
    return FeaturePrep(num, medians, means, scales, specs)


@dataclass
class FeatureMatrices:
    train: DataFrame
    test: DataFrame
    prep: FeaturePrep
    label: str


def build_feature_matrices(
    df: DataFrame,
    key_cols: Sequence[str] = ("HotelCode",),
    target: str = TARGET,
    test_share: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
    drop_identifiers: bool = True,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[tuple[str, int]] = CATEGORICAL_CAPS,
    materialize_input: bool = True,
) -> FeatureMatrices:
    """Split (exact sizes, stratified when few classes), fit on train only,
    transform both sides. Output frames: key columns, ``label``, ``features``.

    ``materialize_input`` checkpoints the projected input first; turn it off
    when ``df`` is already a scan of a written table."""
    from staysift.operators.sampling import with_split_flag
    from staysift.operators.schema import rename_aliases
    from staysift.session import materialize, tasks_of

    df = rename_aliases(df)
    if target not in df.columns:
        raise KeyError(f"Missing target column {target!r}")
    needed = list(dict.fromkeys(
        [*key_cols, target, *[c for c in numeric if c in df.columns], *[c for c, _ in categorical if c in df.columns]]
    ))
    # one pass over the (possibly long) upstream plan; the split's ranking jobs,
    # the fit aggregations and both transforms read the checkpoint instead
    source = materialize(df.select(*needed)) if materialize_input else df.select(*needed)
    flagged = with_split_flag(source, list(key_cols), target, test_share, seed, stratify)
    # few bytes a row here, a wide vector later: tasks are bounded by rows
    flagged = materialize(tasks_of(flagged, source.count(), ROWS_PER_TASK))
    train = flagged.where(F.col("split") == "train").drop("split")
    test = flagged.where(F.col("split") == "test").drop("split")
    prep = fit_feature_prep(train, numeric, categorical)
    keep = [*key_cols, F.col(target).cast("double").alias("label"), "features"]

    def _t(x: DataFrame) -> DataFrame:
        return materialize(prep.transform(x).select(*keep))

    return FeatureMatrices(_t(train), _t(test), prep, "label")
