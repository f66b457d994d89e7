"""Penalised linear models from Gram matrices of hashed folds.

One pass over the data aggregates, for each fold, the Gram matrix of (1, features, label). The
moments of a training set are the total less those of the held-out fold, and the squared
error of any coefficients on a fold is a quadratic form of its matrix, so every penalty and
fold is then a small dense computation: no refits, whatever the number of penalties.

The matrices' size is bounded by the width of the design, not by the rows. Tasks add up their own
rows by matrix products; partial matrices are summed in a tree of bounded groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREE = (4096, 64, 1)  # groups of each level of the sum over tasks
BLOCK_ROWS = 2048


def fold_of(keys: Sequence[str], folds: int, seed: int = 42) -> Column:
    """The fold of a row, 0 to ``folds - 1``, by a hash of its key columns and the seed."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def fold_grams(
    df: DataFrame, keys: Sequence[str], folds: int = 3, seed: int = 42, features: str = "features", label: str = "label"
) -> np.ndarray:
    """``folds`` Gram matrices of (1, features, label), in one pass. Rows with a NULL label or
    vector are left out; an empty fold's matrix is zero."""
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        fold_of(keys, folds, seed).alias("fold"), vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")
    )

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: np.ndarray | None = None
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                n = batch.num_rows
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                a = np.hstack((np.ones((n, 1)), x, batch.column(2).to_numpy(zero_copy_only=False)[:, None]))
                fold = batch.column(0).to_numpy(zero_copy_only=False)
                if sums is None:
                    sums = np.zeros((folds, a.shape[1], a.shape[1]))
                for f in np.unique(fold).tolist():
                    part = a[fold == f]
                    sums[f] += part.T @ part
        if sums is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * folds, pa.int32()), pa.array(range(folds), pa.int32()),
                    pa.array([m.tobytes() for m in sums], pa.binary()),
                ],
                ["part", "fold", "sums"],
            )

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, dtype=float) for b in frame["sums"]], axis=0)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "fold": frame["fold"].iloc[:1], "sums": [total.tobytes()]})

    parts = rows.mapInArrow(of_task, "part int, fold int, sums binary")
    for groups in TREE:
        parts = parts.withColumn("part", F.col("part") % groups).groupBy("part", "fold").applyInPandas(
            added, "part int, fold int, sums binary"
        )
    found = {r["fold"]: np.frombuffer(bytes(r["sums"]), dtype=float) for r in parts.collect()}
    if not found:
        raise ValueError("no rows with features and a label")
    width = int(round(np.sqrt(len(next(iter(found.values()))))))
    return np.stack([found[f].reshape(width, width) if f in found else np.zeros((width, width)) for f in range(folds)])


@dataclass
class Centred:
    """Centred moments of a Gram matrix: rows, means, and sums of squares and products."""

    n: float
    mean_x: np.ndarray
    mean_y: float
    xx: np.ndarray
    xy: np.ndarray

    @staticmethod
    def of(gram: np.ndarray) -> Centred:
        n = gram[0, 0]
        mean = gram[0, 1:] / n
        c = gram[1:, 1:] - n * np.outer(mean, mean)
        return Centred(n, mean[:-1], mean[-1], c[:-1, :-1], c[:-1, -1])

    def intercept(self, w: np.ndarray) -> float:
        return float(self.mean_y - self.mean_x @ w)


def ridge_path(gram: np.ndarray, alphas: Sequence[float]) -> list[tuple[float, np.ndarray]]:
    """``(intercept, coefficients)`` that minimise ``||y - b - Xw||^2 + alpha ||w||^2`` for each
    alpha: one eigen-decomposition for all. Directions without variance get no weight."""
    c = Centred.of(gram)
    values, vectors = np.linalg.eigh(c.xx)
    along = vectors.T @ c.xy
    least = max(values.max(), 0) * len(values) * np.finfo(float).eps
    out = []
    for alpha in alphas:
        w = vectors @ np.where(values > least, along / np.maximum(values + alpha, 1e-300), 0)
        out.append((c.intercept(w), w))
    return out


def lasso_path(
    gram: np.ndarray, alphas: Sequence[float], tol: float = 1e-10, max_sweeps: int = 100_000
) -> list[tuple[float, np.ndarray]]:
    """``(intercept, coefficients)`` that minimise ``||y - b - Xw||^2 / 2n + alpha |w|`` for each
    alpha (in the order given). Coordinate descent on the moments, from the largest penalty down,
    each from the solution before; sweeps run over the active coordinates until these rest, and
    end when no coordinate violates its subgradient condition."""
    c = Centred.of(gram)
    a, b = c.xx / c.n, c.xy / c.n
    scale = np.diag(a).copy()
    usable = scale > 1e-12 * max(1e-300, scale.max(initial=0))
    w, found = np.zeros(len(b)), {}
    residual = b - a @ w  # the gradient of the loss, with the sign turned
    limit = tol * max(1.0, np.abs(b).max(initial=0))

    def sweep(coordinates: np.ndarray, alpha: float) -> float:
        nonlocal residual
        moved = 0.0
        for k in coordinates:
            z = residual[k] + scale[k] * w[k]
            new = np.sign(z) * max(0.0, abs(z) - alpha) / scale[k]
            if new != w[k]:
                residual -= a[:, k] * (new - w[k])
                moved = max(moved, abs(new - w[k]) * scale[k])
                w[k] = new
        return moved

    for alpha in sorted(set(alphas), reverse=True):
        for _ in range(max_sweeps):
            sweep(np.flatnonzero(usable), alpha)
            for _ in range(max_sweeps):
                if sweep(np.flatnonzero(w), alpha) <= limit:
                    break
            w = _polished(a, b, w, alpha)
            residual = b - a @ w  # without the rounding of many small steps
            if kkt_violation(gram, w, alpha) <= 10 * limit:
                break
        found[alpha] = (c.intercept(w), w.copy())
    return [found[alpha] for alpha in alphas]


def _polished(a: np.ndarray, b: np.ndarray, w: np.ndarray, alpha: float) -> np.ndarray:
    """The exact solution with the signs of ``w``, where it keeps them."""
    on = np.flatnonzero(w)
    if not len(on):
        return w
    try:
        exact = np.linalg.solve(a[np.ix_(on, on)], b[on] - alpha * np.sign(w[on]))
    except np.linalg.LinAlgError:  # collinear columns: many solutions, the one at hand will do
        return w
    if not np.isfinite(exact).all() or (np.sign(exact) != np.sign(w[on])).any():
        return w
    out = np.zeros_like(w)
    out[on] = exact
    return out


def kkt_violation(gram: np.ndarray, w: np.ndarray, alpha: float) -> float:
    """By how much coefficients miss the subgradient conditions of the lasso."""
    c = Centred.of(gram)
    gradient = (c.xy - c.xx @ w) / c.n
    off = np.where(w != 0, np.abs(gradient - alpha * np.sign(w)), np.maximum(0, np.abs(gradient) - alpha))
    return float(off[np.diag(c.xx) > 1e-12 * max(1e-300, np.diag(c.xx).max(initial=0))].max(initial=0))


def errors(gram: np.ndarray, intercept: float, w: np.ndarray) -> tuple[float, float]:
    """RMSE and R^2 of coefficients on the rows of a Gram matrix (NaN without rows)."""
    n = gram[0, 0]
    if not n:
        return float("nan"), float("nan")
    v = np.concatenate(([-intercept], -w, [1.0]))
    sse = max(0.0, float(v @ gram @ v))
    sst = float(gram[-1, -1] - gram[0, -1] ** 2 / n)
    return float(np.sqrt(sse / n)), 1 - sse / sst if sst > 0 else float("nan")


@dataclass
class PenaltySearch:
    """Errors of each penalty on each held-out fold, the chosen penalty and the fit on all rows."""

    rows: list[tuple[float, int, float, float]]  # alpha, fold, rmse, r2
    alpha: float
    intercept: float
    coefficients: np.ndarray

    def mean_rmse(self) -> dict[float, float]:
        out: dict[float, list[float]] = {}
        for alpha, _, rmse, _ in self.rows:
            out.setdefault(alpha, []).append(rmse)
        return {alpha: float(np.nanmean(v)) for alpha, v in out.items()}


def search_penalty(grams: np.ndarray, alphas: Sequence[float], kind: str = "ridge", scoring: str = "rmse") -> PenaltySearch:
    """Cross-validate the penalties of ``ridge`` or ``lasso``; the best mean error over the folds
    (``rmse`` or ``r2``) wins, ties to the penalty named first. Folds without held-out or without
    training rows take no part."""
    path = {"ridge": ridge_path, "lasso": lasso_path}[kind]
    total, rows = grams.sum(axis=0), []
    for fold, held in enumerate(grams):
        if 0 < held[0, 0] < total[0, 0]:
            for alpha, (b, w) in zip(alphas, path(total - held, alphas), strict=True):
                rows.append((float(alpha), fold, *errors(held, b, w)))
    if not rows:
        raise ValueError("cross-validation needs rows in two folds at least")
    score = {a: np.nanmean([(-e if scoring == "rmse" else r) for x, _, e, r in rows if x == float(a)]) for a in alphas}
    best = max(alphas, key=lambda a: score[a])
    intercept, w = path(total, [best])[0]
    return PenaltySearch(rows, float(best), intercept, w)
