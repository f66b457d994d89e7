"""Penalised models from fold Gram matrices against refits and optimality conditions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from staysift.operators import gram, models


def design(rng, n=400, p=12):
    """A design with a constant column, a collinear pair and a one-hot block."""
    x = rng.standard_normal((n, p)) * rng.uniform(0.1, 5, p)
    x[:, 3] = 2.0
    x[:, 5] = -3 * x[:, 4]
    level = rng.integers(0, 4, n)
    x = np.hstack((x, np.eye(4)[level]))
    y = x @ np.where(rng.random(p + 4) < 0.5, rng.standard_normal(p + 4), 0) + rng.standard_normal(n) + 7
    return x, y


def gram_of(x, y):
    a = np.column_stack((np.ones(len(x)), x, y))
    return a.T @ a


def test_one_pass_gives_the_folds_matrices(spark):
    rng = np.random.default_rng(2)
    x, y = design(rng)
    sparse = lambda r: Vectors.sparse(len(r), {i: float(v) for i, v in enumerate(r) if v})
    rows = [(k, f"k{k}", sparse(r) if k % 2 else Vectors.dense(r), float(v)) for k, (r, v) in enumerate(zip(x, y, strict=True))]
    rows += [(9000, "no label", Vectors.dense(x[0]), None), (9001, "no vector", None, 1.0)]
    df = spark.createDataFrame(rows, ["id", "name", "features", "label"]).repartition(5)
    got = gram.fold_grams(df, ["id", "name"], 3, 7)
    fold = {r["id"]: r["f"] for r in df.select("id", gram.fold_of(["id", "name"], 3, 7).alias("f")).collect()}
    for f in range(3):
        at = np.array([fold[k] == f for k in range(len(x))])
        assert 80 < at.sum() < 200
        assert np.allclose(got[f], gram_of(x[at], y[at]), rtol=1e-12, atol=1e-9)
    with pytest.raises(ValueError):
        gram.fold_grams(df.where("id < 0"), ["id"])


def test_ridge_path_solves_the_normal_equations():
    x, y = design(np.random.default_rng(3))
    c = x - x.mean(axis=0)
    for alpha, (b, w) in zip([1e-3, 1.0, 50.0], gram.ridge_path(gram_of(x, y), [1e-3, 1.0, 50.0]), strict=True):
        want = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ (y - y.mean()))
        assert np.allclose(w, want, atol=1e-7) and np.isclose(b, y.mean() - x.mean(axis=0) @ want)
    (b, w), = gram.ridge_path(gram_of(x, y), [0.0])
    assert np.allclose(x @ w + b, np.column_stack((np.ones(len(x)), x)) @ np.linalg.lstsq(np.column_stack((np.ones(len(x)), x)), y, rcond=None)[0])


def test_lasso_path_meets_the_subgradient_conditions():
    x, y = design(np.random.default_rng(4))
    g = gram_of(x, y)
    alphas = [0.3, 1e-4, 1.0, 0.02, 5000.0]
    path = gram.lasso_path(g, alphas)
    sizes = [int((w != 0).sum()) for _, w in path]
    assert sizes[4] == 0 and sizes[1] >= sizes[3] >= sizes[0] >= sizes[2]
    loss = lambda b, w, a: ((y - b - x @ w) ** 2).mean() / 2 + a * np.abs(w).sum()
    rng = np.random.default_rng(0)
    for alpha, (b, w) in zip(alphas, path, strict=True):
        assert gram.kkt_violation(g, w, alpha) < 1e-8
        assert np.isclose(b, (y - x @ w).mean())
        for _ in range(50):  # no step in any direction is better
            step = rng.standard_normal(len(w)) * 1e-3
            assert loss(b, w, alpha) <= loss((y - x @ (w + step)).mean(), w + step, alpha) + 1e-12


@pytest.mark.parametrize("kind", ["ridge", "lasso"])
def test_search_equals_refits(kind):
    rng = np.random.default_rng(5)
    x, y = design(rng, 300)
    fold = rng.integers(0, 4, 300)
    grams = np.stack([gram_of(x[fold == f], y[fold == f]) if (fold == f).any() else np.zeros((18, 18)) for f in range(5)])
    alphas = [0.01, 0.1, 1.0]
    found = gram.search_penalty(grams, alphas, kind)
    path = {"ridge": gram.ridge_path, "lasso": gram.lasso_path}[kind]
    want = {a: [] for a in alphas}
    for f in range(4):
        for a, (b, w) in zip(alphas, path(gram_of(x[fold != f], y[fold != f]), alphas), strict=True):
            want[a].append(np.sqrt(((y - b - x @ w)[fold == f] ** 2).mean()))
    got = found.mean_rmse()
    assert all(np.isclose(got[a], np.mean(v), rtol=1e-9) for a, v in want.items())
    assert found.alpha == min(alphas, key=lambda a: np.mean(want[a]))


def test_tuned_models_equal_their_gram_solution(spark):
    """The model that is fitted with the chosen penalty has the coefficients of the search."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((500, 4)) * [1, 2, 3, 4]
    y = x @ [1.0, -2.0, 0.0, 0.5] + rng.standard_normal(500)
    rows = [(k, Vectors.dense(r), float(v)) for k, (r, v) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    for name in ("ridge", "lasso"):
        found = models.tune_penalty(df, name, ["id"])
        run = models.train_regressor(df, df, name, tune=True, keys=["id"])
        assert run.best_params == {"alpha": found.alpha}
        assert np.allclose(run.model.coefficients.toArray(), found.coefficients, atol=1e-5)
        assert np.isclose(run.model.intercept, found.intercept, atol=1e-5)
    assert df.where(F.col("label").isNull()).count() == 0
