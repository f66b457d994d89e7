"""Bounded labelled samples for fitting the classifiers, and their calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import held_out


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, float]:
    """At most ``per_class`` training documents of each class (0, 1): columns ``id``,
    ``text`` (whole) and ``label``; and the share of class 1 among all training labels
    (0.5 if there are none).

    Only ids that are not held out take part; NULL ids, labels and texts do not. The
    choice is by a hash of the id, so it does not depend on partitioning. A document with
    both labels counts as 1; a repeated id is one document of its least text.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out("id"))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .withColumn("h", F.xxhash64("id"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy("h", "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    # at most 2 * per_class ids
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return rows, share


def with_prior(model: tuple[np.ndarray, np.ndarray, np.ndarray], y: np.ndarray, share: float):
    """The logistic model fitted on a sample with labels ``y``, moved to the share of
    class 1 among all rows."""
    w, mean, scale = model
    odds = lambda p: np.log(max(p, 1e-6) / max(1 - p, 1e-6))
    moved = w.copy()
    moved[-1] += odds(share) - odds(float(y.mean()))
    return moved, mean, scale


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps on standardised columns: weights (the last is
    the intercept), means and scales."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], l2 * len(x))
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def predict_logistic(model: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    w, mean, scale = model
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))
