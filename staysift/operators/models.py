"""Regressors, tuning, scoring and evaluation on ``pyspark.ml``.

Estimators train distributed; the metrics are one aggregation over the scored
test set. The alpha conventions of the reference's penalised models are mapped
onto Spark's objective (see ``ridge``).
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysift.operators import deep_forest
from staysift.operators.gram import PenaltySearch, fold_grams, search_penalty
from staysift.session import tasks_of

# --- fixed values: must equal the source project's for the same results --------
RIDGE_CV_ALPHAS = [float(a) for a in np.logspace(-3, 3, 13)]
LASSO_SEARCH_ALPHAS = [float(a) for a in np.logspace(-4, 0, 20)]
FOREST_SEARCH = {
    "numTrees": [120, 200, 300, 500],
    "maxDepth": [10, 16, 24, 30],  # 30 stands for "unlimited" (Spark's maximum)
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2", "0.5", "all"],
}
BOOSTED_SEARCH = {
    "maxIter": [200, 300, 500, 700],
    "maxDepth": [4, 6, 8, 10],
    "stepSize": [0.03, 0.05, 0.08, 0.12],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.6", "0.8", "all"],
}
TOLERANCES = (0.5, 1.0)
# --- end of fixed values -----------------------------------------------------------
TREE_TASK_BYTES = 128 << 20  # of binned features in one task
DEEP = 10  # forests of deeper trees are grown by ``deep_forest``


def label_scale(train: DataFrame, label: str = "label") -> tuple[float, int]:
    """Population sd and count of the label (used to translate alphas)."""
    row = train.agg(F.stddev_pop(label).alias("s"), F.count(label).alias("n")).first()
    return float(row.s or 0.0), int(row.n)


def linear(features: str = "features", label: str = "label") -> LinearRegression:
    """Ordinary least squares (the default solver copes with a singular one-hot design)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, elasticNetParam=0.0)


def ridge(alpha: float, label_sd: float, n: int, features: str = "features", label: str = "label") -> LinearRegression:
    """Ridge equal to minimising ||y - Xw||^2 + alpha ||w||^2.

    Spark minimises (1/2n)||y - Xw||^2 + (regParam/2)||w||^2 on a label divided
    by its sd, so regParam = alpha * sd(y) / n (population sd, normal solver)."""
    reg = alpha * label_sd / n if n else alpha
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
        standardization=False, solver="normal",
    )


def lasso(alpha: float, features: str = "features", label: str = "label", max_iter: int = 10_000, tol: float = 1e-10) -> LinearRegression:
    """Lasso with the (1/2n) squared-loss convention: regParam = alpha."""
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
        standardization=False, maxIter=max_iter, tol=tol,
    )


def forest(
    num_trees: int = 100, max_depth: int = 20, seed: int = 42, min_leaf: int = 1,
    feature_subset: str = "all", features: str = "features", label: str = "label",
) -> RandomForestRegressor:
    """Random forest; every split considers all features by default. Trees deeper than
    Spark's limit of 30 are an error, not another model."""
    if max_depth > 30:
        raise ValueError(f"max_depth {max_depth} is over Spark's limit of 30")
    return RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy=feature_subset, seed=seed,
    )


def boosted(
    n_estimators: int = 300, max_depth: int = 8, learning_rate: float = 0.05, subsample: float = 0.8,
    colsample: float = 0.8, seed: int = 42, features: str = "features", label: str = "label",
) -> GBTRegressor:
    """Gradient-boosted trees (squared loss); column sampling per tree node set."""
    return GBTRegressor(
        featuresCol=features, labelCol=label, maxIter=n_estimators, maxDepth=max_depth,
        stepSize=learning_rate, subsamplingRate=subsample, featureSubsetStrategy=str(colsample), seed=seed,
    )


def sample_param_maps(estimator: Estimator, grid: dict[str, list], n_iter: int, seed: int) -> list[dict]:
    """Seeded random draws (without repetition) from the full grid."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    rng = random.Random(seed)
    return maps if n_iter >= len(maps) else rng.sample(maps, n_iter)


def cross_validate(
    estimator: Estimator, param_maps: list[dict], folds: int = 3, seed: int = 42, parallelism: int = 4,
    label: str = "label",
) -> CrossValidator:
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator,
        numFolds=folds, seed=seed, parallelism=parallelism,
    )


def best_params(cv_model) -> dict[str, Any]:
    """Parameters of the lowest-RMSE candidate."""
    idx = int(np.argmin(cv_model.avgMetrics))
    return {p.name: v for p, v in cv_model.getEstimatorParamMaps()[idx].items()}


def regression_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, R^2 (1 - SSE/SST) and shares within 0.5 / 1.0; one pass."""
    err = F.col(prediction) - F.col(label)
    aggs = [
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - F.sum(err * err) / (F.var_pop(label) * F.count(label))).alias("r2"),
    ]
    for t in TOLERANCES:
        name = "within_" + str(t).replace(".", "_")
        aggs.append(F.avg((F.abs(err) <= t).cast("double")).alias(name))
    aggs.append(F.count(F.lit(1)).cast("bigint").alias("n"))
    return scored.agg(*aggs)


def metrics_by_bucket(scored: DataFrame, bucket: Column | str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The same metrics per bucket (e.g. per true rating)."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    err = F.col(prediction) - F.col(label)
    return scored.groupBy(b.alias("bucket")).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg((F.abs(err) <= 0.5).cast("double")).alias("within_0_5"),
        F.avg((F.abs(err) <= 1.0).cast("double")).alias("within_1_0"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
    )


def coefficient(model, feature_names: Sequence[str], feature: str) -> float:
    """Coefficient of a named feature; an unknown name is an error."""
    by_name = dict(zip(feature_names, model.coefficients.toArray(), strict=True))
    if feature not in by_name:
        raise KeyError(f"the model has no feature {feature!r}; it has {', '.join(by_name)}")
    return float(by_name[feature])


def feature_importance(model, feature_names: Sequence[str], spark) -> DataFrame:
    """Tree-model importances with feature names, most important first."""
    imp = model.featureImportances.toArray().tolist()
    rows = list(zip(feature_names, [float(v) for v in imp]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass
class RunResult:
    model_name: str
    tuned: bool
    model: Model | deep_forest.DeepForest
    metrics: dict[str, float]
    best_params: dict[str, Any] = field(default_factory=dict)


def make_estimator(name: str, train: DataFrame, params: dict[str, Any] | None = None, seed: int = 42) -> Estimator:
    p = dict(params or {})
    if name == "linear":
        return linear()
    if name == "ridge":
        sd, n = label_scale(train)
        return ridge(p.get("alpha", 1.0), sd, n)
    if name == "lasso":
        return lasso(p.get("alpha", 0.001))
    if name == "rf":
        return forest(p.get("n_estimators", 100), p.get("max_depth", 20), seed, p.get("min_leaf", 1))
    if name == "xgb":
        return boosted(
            p.get("n_estimators", 300), p.get("max_depth", 8), p.get("learning_rate", 0.05),
            p.get("subsample", 0.8), p.get("colsample", 0.8), seed,
        )
    raise ValueError(f"unknown model {name!r}")


def bounded_tasks(train: DataFrame, features: str = "features") -> DataFrame:
    """``train`` in partitions of bounded size as the tree learners hold it: they keep one
    4-byte bin for each feature of each row and read it again for every group of nodes."""
    row = train.select(features).first()
    width = 4 * len(row[0]) if row and row[0] is not None else 4
    return tasks_of(train, train.count(), max(1, TREE_TASK_BYTES // max(4, width)))


def tuning_grid(name: str) -> tuple[dict[str, list], int | None]:
    """(grid, draws) of the tree models; their searches are sampled."""
    return {"rf": (FOREST_SEARCH, 12), "xgb": (BOOSTED_SEARCH, 12)}.get(name, ({}, None))


def tune_penalty(
    train: DataFrame, name: str, keys: Sequence[str], folds: int = 3, draws: int = 12, seed: int = 42
) -> PenaltySearch:
    """Ridge over all 13 penalties, lasso over ``draws`` of its 20: one pass over the training
    set, then no refits (see ``operators.gram``). Folds are a hash of the ``keys``."""
    grams = fold_grams(train, keys, folds, seed)
    if name == "ridge":
        return search_penalty(grams, RIDGE_CV_ALPHAS, "ridge", "r2")
    drawn = random.Random(seed).sample(LASSO_SEARCH_ALPHAS, min(draws, len(LASSO_SEARCH_ALPHAS)))
    return search_penalty(grams, drawn, "lasso", "rmse")


def train_regressor(
    train: DataFrame, test: DataFrame, name: str, params: dict[str, Any] | None = None, tune: bool = False,
    folds: int = 3, draws: int = 12, seed: int = 42, parallelism: int = 4, keys: Sequence[str] = (),
) -> RunResult:
    """Fit one model (optionally tuned by k-fold CV), score the test split and compute the
    metrics. ``keys`` name the rows for the folds of the penalised models (default: all columns
    but the features)."""
    chosen: dict[str, Any] = {}
    if tune and name in ("ridge", "lasso"):
        found = tune_penalty(train, name, keys or [c for c in train.columns if c != "features"], folds, draws, seed)
        chosen = {"alpha": found.alpha}
        model = make_estimator(name, train, chosen, seed).fit(train)
    elif tune and name != "linear":
        train = bounded_tasks(train)
        est = make_estimator(name, train, params, seed)
        maps = sample_param_maps(est, tuning_grid(name)[0], draws, seed)
        cv = cross_validate(est, maps, folds, seed, parallelism).fit(train)
        chosen = best_params(cv)
        model = cv.bestModel
    elif name == "rf" and (params or {}).get("max_depth", 20) > DEEP:
        est = make_estimator(name, train, params, seed)  # checks the parameters
        model = deep_forest.fit(train, est.getNumTrees(), est.getMaxDepth(), seed, est.getMinInstancesPerNode())
    else:
        train = bounded_tasks(train) if name in ("rf", "xgb") else train
        model = make_estimator(name, train, params, seed).fit(train)
    scored = model.transform(test)
    m = regression_metrics(scored).first().asDict()
    return RunResult(name, tune, model, m, chosen)


def compare_runs(spark, runs: Sequence[RunResult]) -> DataFrame:
    """One row per run, ranked by RMSE."""
    rows = [
        (r.model_name, r.tuned, float(r.metrics["rmse"]), float(r.metrics["mae"]), float(r.metrics["r2"]),
         float(r.metrics["within_0_5"]), float(r.metrics["within_1_0"]), str(r.best_params))
        for r in runs
    ]
    schema = "model string, tuned boolean, rmse double, mae double, r2 double, within_0_5 double, within_1_0 double, best_params string"
    return spark.createDataFrame(rows, schema).orderBy("rmse", "model")
