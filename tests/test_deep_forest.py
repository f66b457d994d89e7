"""Deep forests against brute force, in one task and in many."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from staysift.operators import deep_forest as D
from staysift.operators import models


def brute(x, y, w, thresholds, depth, min_leaf):
    """Predictions of the rows by one tree grown row by row."""
    out = np.zeros(len(y))

    def grow(rows, rest):
        out[rows] = np.average(y[rows], weights=w[rows])
        best = (1e-8, None)
        total = (w[rows] * y[rows]).sum() ** 2 / w[rows].sum()
        for f, cuts in enumerate(thresholds):
            for t in cuts:
                left = x[rows, f] <= t
                a, b = rows[left], rows[~left]
                if not rest or min(w[a].sum(), w[b].sum()) < min_leaf:
                    continue
                gain = sum((w[p] * y[p]).sum() ** 2 / w[p].sum() for p in (a, b)) - total
                if gain > best[0] + 1e-9:
                    best = (gain, (a, b))
        if best[1]:
            for part in best[1]:
                grow(part, rest - 1)

    grow(np.arange(len(y)), depth)
    return out


def table(rng, n):
    x = np.column_stack([rng.normal(size=n), rng.integers(-2, 3, n) * 1.5, rng.exponential(size=n), np.eye(4)[rng.integers(0, 4, n)], np.zeros(n)])
    y = np.round(x[:, 0] * x[:, 3] + x[:, 1] + rng.normal(size=n), 2)
    return x, y


@pytest.mark.parametrize(("depth", "min_leaf"), [(20, 1), (3, 4)])
def test_a_tree_equals_brute_force(depth, min_leaf):
    rng = np.random.default_rng(depth)
    x, y = table(rng, 300)
    w = rng.integers(1, 4, 300).astype(float)
    bins = D.Bins([D.find_thresholds(c[c != 0], int((c == 0).sum())) for c in x.T])
    assert max(len(t) for t in bins.thresholds) == 31 and len(bins.thresholds[-1]) == 0
    row, feature = np.nonzero(x)
    codes = bins.coded(row, feature, x[row, feature], len(x))
    assert codes.shape[1] <= 4  # nothing is kept of zeros
    tree, gains = D.Tree.root(depth), np.zeros(x.shape[1])
    D.grow_below(tree, np.array([0]), np.zeros(300, dtype=np.int64), codes, y, w, bins, min_leaf, gains)
    back = D.Tree.from_bytes(tree.to_bytes())
    assert np.allclose(back.value[back.leaves(codes, bins)], brute(x, y, w, bins.thresholds, depth, min_leaf))
    assert gains[-1] == 0 and gains[1] > 0


def frame(spark, rng, n):
    x, y = table(rng, n)
    mixed = [Vectors.dense(v) if i % 3 else Vectors.sparse(len(v), list(np.flatnonzero(v)), v[v != 0]) for i, v in enumerate(x)]
    return spark.createDataFrame([(i, float(y[i]), mixed[i]) for i in range(n)], ["k", "label", "features"]).repartition(4)


def test_trees_in_many_tasks_equal_trees_in_one(spark):
    """Rows over a task's bytes: upper levels are summed over the blocks, the rest is dealt."""
    data = frame(spark, np.random.default_rng(2), 900).cache()
    one = D.fit(data, 5, 12, seed=3)
    many = D.fit(data, 5, 12, seed=3, task_bytes=6000)
    assert one.pieces.count() == 5 and many.pieces.count() > 20
    a, b = ({r["k"]: r["prediction"] for r in m.transform(data).collect()} for m in (one, many))
    assert len(a) == 900 and a.keys() == b.keys()
    assert np.allclose([a[k] for k in a], [b[k] for k in a])
    assert np.allclose(one.featureImportances.toArray(), many.featureImportances.toArray())
    assert one.transform(data).columns == ["k", "label", "prediction"]


def test_a_deep_forest_is_grown_saved_and_loaded(spark, tmp_path, monkeypatch):
    """As good as Spark's learner, which would read the rows again for each group of nodes."""
    rng = np.random.default_rng(7)
    train, test = frame(spark, rng, 1500).cache(), frame(spark, rng, 500).cache()
    theirs = models.regression_metrics(models.forest(30, 20).fit(train).transform(test)).first()
    monkeypatch.setattr(models, "bounded_tasks", lambda *_: pytest.fail("Spark's learner"))
    run = models.train_regressor(train, test, "rf", {"n_estimators": 30, "max_depth": 20})
    assert run.metrics["n"] == 500 and run.metrics["rmse"] == pytest.approx(theirs["rmse"], rel=0.05)
    assert run.model.featureImportances.toArray().sum() == pytest.approx(1)
    run.model.write().overwrite().save(str(tmp_path / "m"))
    back = D.DeepForest.load(spark, str(tmp_path / "m"))
    assert models.regression_metrics(back.transform(test)).first()["rmse"] == pytest.approx(run.metrics["rmse"])
    with pytest.raises(ValueError):
        models.train_regressor(train, test, "rf", {"max_depth": 31})
