"""Sinks: tables, feature bundles, model runs and reports.

Everything is written through Spark writers (distributed, any Hadoop file
system); small JSON documents are written as one-row DataFrames.
"""

from __future__ import annotations

import json
import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table as Parquet or CSV (header, values written verbatim)."""
    w = df.write.mode(mode)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        (
            w.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def write_json_doc(spark: SparkSession, doc: dict[str, Any], path: str) -> str:
    """One JSON document as a single-line JSON file set."""
    spark.createDataFrame([(json.dumps(doc, default=str),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path


def save_feature_bundle(out_dir: str, matrices, meta: dict[str, Any] | None = None) -> dict[str, str]:
    """Train/test matrices (key, label, features) as Parquet, the fitted
    preprocessing constants as JSON, and optional metadata."""
    from staysift.operators.features import save_feature_prep

    spark = matrices.train.sparkSession
    paths = {
        "train": write_table(matrices.train, os.path.join(out_dir, "train")),
        "test": write_table(matrices.test, os.path.join(out_dir, "test")),
        "preprocessor": save_feature_prep(matrices.prep, spark, os.path.join(out_dir, "preprocessor")),
    }
    if meta:
        paths["meta"] = write_json_doc(spark, meta, os.path.join(out_dir, "feature_matrix_meta"))
    return paths


def save_model_run(spark: SparkSession, run, out_dir: str, extra: dict[str, Any] | None = None) -> dict[str, str]:
    """Persist the fitted model (Spark ML format) and a metrics document."""
    model_path = os.path.join(out_dir, "regressor")
    run.model.write().overwrite().save(model_path)
    doc = {"model": run.model_name, "tuned": run.tuned, "best_params": run.best_params, **run.metrics, **(extra or {})}
    return {"model": model_path, "metrics": write_json_doc(spark, doc, os.path.join(out_dir, "metrics"))}


def write_report(df: DataFrame, path: str) -> str:
    """A (small) result table as JSON lines."""
    df.repartition(1).write.mode("overwrite").json(path)
    return path
