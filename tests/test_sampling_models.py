"""Sampling, feature matrices, models and the permutation test."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from staysift.operators import features, models, permutation, sampling


def _tiny_joined(spark, n):
    rows = []
    for i in range(n):
        rows.append((
            "US" if i % 2 == 0 else "AL", "United States" if i % 2 == 0 else "Albania", f"{i % 5}",
            f"City {i % 4}", str(100 + i), f"Inn {i}", 3 + i % 3, i % 4, 1 + i % 5, i % 3,
            40.0 + 0.01 * i, -74.0 - 0.01 * i, float(1_000_000 - 1000 * i),
        ))
    schema = ("countyCode string, countyName string, cityCode string, cityName string, HotelCode string, "
              "HotelName string, hotel_star_rating int, attractions_count bigint, facilities_count bigint, "
              "facilities_keyword_hits bigint, hotel_latitude double, hotel_longitude double, city_population double")
    return spark.createDataFrame(rows, schema)


def test_exact_sample_bruteforce(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in sampling.exact_sample(df, 250, ["k"], seed=7).collect())
    want = sorted(sorted(range(3000), key=lambda k: hashlib.md5(f"{k}|7".encode()).hexdigest())[:250])
    assert got == want


def test_split_disjoint_exhaustive_stratified(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"))
    flagged = sampling.with_split_flag(df, ["k"], "y", 0.2, 42, True)
    counts = {(r.y, r.split): r.c for r in flagged.groupBy("y", "split").agg(F.count("*").alias("c")).collect()}
    assert sum(counts.values()) == 1000
    assert sum(v for (y, s), v in counts.items() if s == "test") == 200
    assert flagged.select("k").distinct().count() == 1000
    for y in range(3):
        assert abs(counts[(y, "test")] - 0.2 * (334 if y == 0 else 333)) < 1


def test_split_is_partition_independent(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 4).alias("y"))
    a = sampling.with_split_flag(df.repartition(3), ["k"], "y").where("split = 'test'").select("k")
    b = sampling.with_split_flag(df.repartition(11), ["k"], "y").where("split = 'test'").select("k")
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())


def test_feature_matrix_smoke(spark):
    fm = features.build_feature_matrices(_tiny_joined(spark, 40), ["HotelCode"], test_share=0.25, seed=0, stratify=False)
    assert (fm.train.count(), fm.test.count()) == (30, 10)
    width = len(fm.prep.feature_names)
    assert width > 6
    sizes = {len(r.features) for r in fm.train.union(fm.test).collect()}
    assert sizes == {width}


def test_one_hot_cap_pools_and_ignores_unknown(spark):
    train = spark.createDataFrame([(c,) for c in "aaaabbbccd"], "c string")
    spec = features.fit_categorical(train, "c", 3)
    assert spec.kept == ["a", "b"] and spec.pooled
    prep = features.FeaturePrep([], {}, {}, {}, [spec])
    test = spark.createDataFrame([("a",), ("d",), ("zzz",)], "c string")
    vecs = [r.features.toArray().tolist() for r in prep.transform(test).collect()]
    assert vecs == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, 0.0]]


def test_median_impute_population_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,)], "x double")
    med, mean, scale = features.fit_numeric(df, ["x"])
    filled = np.array([1.0, 2.0, 2.0, 10.0])
    assert med["x"] == 2.0 and mean["x"] == pytest.approx(filled.mean()) and scale["x"] == pytest.approx(filled.std())


def test_permutation_weights_equal_lstsq(spark):
    rng = np.random.default_rng(0)
    n = 200
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 3, n)])
    onehot = np.eye(3)[x[:, 1].astype(int)]
    design = np.column_stack([x[:, 0], onehot])  # singular with the intercept
    y = 1.0 + 2.0 * x[:, 0] + onehot @ np.array([0.0, 0.5, -0.5]) + rng.normal(scale=0.1, size=n)
    rows = [(i, float(y[i]), *[float(v) for v in design[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, label double, a double, b0 double, b1 double, b2 double")
    data = VectorAssembler(inputCols=["a", "b0", "b1", "b2"], outputCol="features").transform(df)
    w = permutation.coefficient_weights(data, ["a", "b0", "b1", "b2"], ["a"])
    coef = w.agg(F.sum(F.col("w_a") * F.col("label"))).first()[0]
    full = np.column_stack([np.ones(n), design])
    beta = np.linalg.lstsq(full, y, rcond=None)[0]
    assert coef == pytest.approx(beta[1], rel=1e-8)


def test_ridge_alpha_mapping(spark):
    rng = np.random.default_rng(1)
    n = 300
    x = rng.normal(size=(n, 2))
    y = 3 + x @ np.array([1.5, -2.0]) + rng.normal(size=n)
    df = spark.createDataFrame([(float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)], "label double, a double, b double")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    sd, cnt = models.label_scale(data)
    m = models.ridge(10.0, sd, cnt).fit(data)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(2), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), want, rtol=1e-6)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.4), (2.0, 3.0), (3.0, 3.2)], "label double, prediction double")
    r = models.regression_metrics(df).first()
    err = np.array([0.4, 1.0, 0.2])
    assert r.rmse == pytest.approx(np.sqrt((err ** 2).mean()))
    assert r.mae == pytest.approx(err.mean())
    assert r.r2 == pytest.approx(1 - (err ** 2).sum() / 2.0)
    assert (r.within_0_5, r.within_1_0) == (pytest.approx(2 / 3), 1.0)


def test_train_and_compare(spark):
    fm = features.build_feature_matrices(_tiny_joined(spark, 120), ["HotelCode"], test_share=0.25, seed=1)
    runs = [models.train_regressor(fm.train, fm.test, "linear"),
            models.train_regressor(fm.train, fm.test, "rf", {"n_estimators": 5, "max_depth": 3})]
    out = models.compare_runs(spark, runs).collect()
    assert len(out) == 2 and out[0].rmse <= out[1].rmse
    imp = models.feature_importance(runs[1].model, fm.prep.feature_names, spark)
    assert imp.count() == len(fm.prep.feature_names)
    with pytest.raises(KeyError):
        models.coefficient(runs[0].model, fm.prep.feature_names, "nope")


def test_feature_bundle_roundtrip(spark):
    import os
    import tempfile

    from staysift.sources.sinks import save_feature_bundle

    df = _tiny_joined(spark, 200).withColumn("cityName", F.concat(F.lit("C"), (F.monotonically_increasing_id() % 90).cast("string")))
    fm = features.build_feature_matrices(df, ["HotelCode"], test_share=0.25, seed=3)
    assert any(s.pooled for s in fm.prep.categorical)
    out = tempfile.mkdtemp(prefix="staysift-bundle-")
    paths = save_feature_bundle(os.path.join(out, "b"), fm, meta={"rows_train": fm.train.count()})
    back = features.load_feature_prep(spark, paths["preprocessor"])
    assert back.feature_names == fm.prep.feature_names
    a = fm.prep.transform(df).select("HotelCode", "features").orderBy("HotelCode").collect()
    b = back.transform(df).select("HotelCode", "features").orderBy("HotelCode").collect()
    assert [r.features for r in a] == [r.features for r in b]


def _lasso_cd(x, y, alpha, iters=5000):
    """Coordinate descent for (1/2n)||y - b0 - Xw||^2 + alpha ||w||_1."""
    n, p = x.shape
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.zeros(p)
    norms = (xc ** 2).sum(0) / n
    for _ in range(iters):
        for j in range(p):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0.0) / norms[j]
    return w


def test_lasso_alpha_convention(spark):
    rng = np.random.default_rng(7)
    n = 400
    x = rng.normal(size=(n, 3)) * np.array([1.0, 3.0, 0.5])
    y = 1 + x @ np.array([0.8, -0.3, 0.0]) + rng.normal(scale=0.5, size=n)
    df = spark.createDataFrame([(float(y[i]), *map(float, x[i])) for i in range(n)], "label double, a double, b double, c double")
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    for alpha in (0.001, 0.1):
        got = models.lasso(alpha).fit(data).coefficients.toArray()
        assert np.allclose(got, _lasso_cd(x, y, alpha), atol=2e-4), alpha


def test_param_draws_are_seeded(spark):
    est = models.forest()
    a = models.sample_param_maps(est, models.FOREST_SEARCH, 12, 42)
    b = models.sample_param_maps(est, models.FOREST_SEARCH, 12, 42)
    assert len(a) == 12 and [sorted((p.name, v) for p, v in m.items()) for m in a] == [
        sorted((p.name, v) for p, v in m.items()) for m in b]


def test_permutation_batches_match_single_plan(spark):
    rng = np.random.default_rng(11)
    n = 300
    rows = [(i, float(rng.normal()), float(rng.normal()), float(rng.normal())) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, label double, a double, b double")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    one = permutation.permutation_test(data, ["k"], ["a", "b"], ["a", "b"], 30, 5, batch_size=None)
    many = permutation.permutation_test(data, ["k"], ["a", "b"], ["a", "b"], 30, 5, batch_size=7)
    key = lambda r: r.feature
    for x, y in zip(sorted(one.collect(), key=key), sorted(many.collect(), key=key)):
        assert x.empirical_p_value_two_sided == y.empirical_p_value_two_sided
        assert x.null_mean == pytest.approx(y.null_mean, rel=1e-12)
        assert x.null_std == pytest.approx(y.null_std, rel=1e-12)
        assert x.n_permutations == y.n_permutations == 30


def test_listing_permutation_observed_equals_lstsq(spark):
    """On the real (singular, one-hot) listing design, the refit-free observed
    coefficients equal a least-squares fit of the collected training matrix."""
    from staysift.plans import queries as Q

    small = "/root/testdata/sf0.001"
    fm = Q._matrices(spark, small)
    names = fm.prep.feature_names
    rows = fm.train.select("label", "features").collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.label for r in rows])
    beta = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
    out = permutation.permutation_test(fm.train, ["HotelCode"], names, ["city_population", "attractions_count"],
                                       n_permutations=5, seed=42)
    got = {r.feature: r.observed_coefficient for r in out.collect()}
    for f in ("city_population", "attractions_count"):
        assert got[f] == pytest.approx(beta[names.index(f) + 1], rel=1e-6, abs=1e-9)
