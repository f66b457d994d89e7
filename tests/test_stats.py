"""Statistics against hand values and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from staysift.operators import explore, profile, ranking, stats


def test_skewness_distinct_missing(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 3.0, 9.0, None]], "x double")
    r = profile.feature_diagnostics(df, "x").first()
    assert r.skewness == pytest.approx(1.969360176, abs=1e-8)
    assert (r.unique_values, r.missing_values) == (4, 1)


def test_pairwise_correlation(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, None), (2.0, 3.0, 1.0), (None, 5.0, 2.0), (4.0, 9.0, 2.5)], "x double, y double, z double")
    got = {(r.col_a, r.col_b): r.corr for r in explore.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert got[("x", "y")] == pytest.approx(0.995871, abs=1e-6)
    assert got[("x", "z")] == pytest.approx(1.0, abs=1e-9)
    assert got[("y", "z")] == pytest.approx(0.928571, abs=1e-6)


def test_empirical_p(spark):
    nulls = spark.createDataFrame([("f", float(i % 7) / 100) for i in range(200)], "feature string, coef double")
    obs = spark.createDataFrame([("f", 1.0)], "feature string, coef double")
    assert stats.null_summary(nulls, obs, "feature", "coef").first().empirical_p_value_two_sided == pytest.approx(1 / 201)
    obs2 = spark.createDataFrame([("f", 0.06)], "feature string, coef double")
    extreme = sum(1 for i in range(200) if (i % 7) / 100 >= 0.06)
    assert stats.null_summary(nulls, obs2, "feature", "coef").first().empirical_p_value_two_sided == pytest.approx(
        (extreme + 1) / 201)


def test_rows_before_matches_cumsum(spark):
    rnd = random.Random(1)
    rows = [(g, float(v), rnd.randint(1, 5)) for g in ("a", "b") for v in rnd.sample(range(10_000), 800)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    got = {(r.g, r.v): r.b for r in ranking.rows_before(df, ["v"], ["g"], "w", buckets=16, out_col="b").collect()}
    for g in ("a", "b"):
        part = sorted((v, w) for gg, v, w in rows if gg == g)
        acc = 0
        for v, w in part:
            assert got[(g, v)] == acc
            acc += w


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(2)
    rows = [(g, float(rnd.randint(0, 40))) for g in range(3) for _ in range(500 + 37 * g)]
    df = spark.createDataFrame(rows, "g int, v double")
    qs = [0.25, 0.5, 0.75, 0.9]
    got = {(r.g, r.q): r.quantile for r in explore.exact_quantiles(df, ["g"], "v", qs).collect()}
    for g in range(3):
        vals = np.array([v for gg, v in rows if gg == g])
        for q in qs:
            assert got[(g, q)] == pytest.approx(float(np.percentile(vals, q * 100)), abs=1e-9)


def test_box_summary_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("a", float(v)) for v in vals], "g string, v double")
    r = explore.box_summary(df, "g", "v").first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert (r.q1, r.q3) == (q1, q3)
    assert r.whisker_high == 8 and r.whisker_low == 1 and r.outliers == 1


def _mw_bruteforce(x, y):
    u = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in x for b in y)
    n1, n2 = len(x), len(y)
    allv = x + y
    counts = {}
    for v in allv:
        counts[v] = counts.get(v, 0) + 1
    tie = sum(t ** 3 - t for t in counts.values())
    n = n1 + n2
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sigma
    return u, z, min(1.0, math.erfc(z / math.sqrt(2)))


def test_mann_whitney_bruteforce(spark):
    rnd = random.Random(3)
    x = [float(rnd.randint(0, 30)) for _ in range(120)]
    y = [float(rnd.randint(3, 35)) for _ in range(90)]
    df = spark.createDataFrame([(v, True) for v in x] + [(v, False) for v in y], "v double, hi boolean")
    r = stats.mann_whitney(df, "v", F.col("hi")).first()
    u, z, p = _mw_bruteforce(x, y)
    assert r.u_statistic == pytest.approx(u)
    assert r.z == pytest.approx(z)
    assert r.p_value == pytest.approx(p, rel=1e-9)


def test_t_distribution_p():
    assert stats.t_two_sided_p(2.228138851986, 10) == pytest.approx(0.05, abs=1e-9)
    assert stats.t_two_sided_p(1.959963984540, 1e7) == pytest.approx(0.05, abs=1e-6)


def test_ols_simple(spark):
    rnd = random.Random(4)
    xs = [rnd.uniform(0, 10) for _ in range(300)]
    ys = [2.0 + 0.5 * x + rnd.gauss(0, 1) for x in xs]
    r = stats.ols_simple(spark.createDataFrame(list(zip(xs, ys)), "x double, y double"), "x", "y").first()
    b, a = np.polyfit(xs, ys, 1)
    assert r.coefficient == pytest.approx(b) and r.intercept == pytest.approx(a)
    resid = np.array(ys) - (a + b * np.array(xs))
    se = math.sqrt((resid ** 2).sum() / (len(xs) - 2) / ((np.array(xs) - np.mean(xs)) ** 2).sum())
    assert r.t == pytest.approx(b / se)
    assert 0.0 <= r.p_value < 1e-10


def test_cohens_d(spark):
    hi, lo = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    df = spark.createDataFrame([(v, True) for v in hi] + [(v, False) for v in lo], "v double, h boolean")
    r = stats.cohens_d(df, "v", F.col("h")).first()
    pooled = math.sqrt((3 * np.var(hi, ddof=1) + 2 * np.var(lo, ddof=1)) / 5)
    assert r.cohens_d == pytest.approx((np.mean(hi) - np.mean(lo)) / pooled)


def test_regression_band_shape(spark):
    rnd = random.Random(5)
    rows = [(i, float(i % 20), 1.0 + 0.1 * (i % 20) + rnd.gauss(0, 0.3)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    out = stats.regression_band(df, "x", "y", ["id"], n_boot=50, grid=10).orderBy("g").collect()
    assert len(out) == 10
    for r in out:
        assert r.band_low <= r.fit <= r.band_high


def test_exact_u_equals_enumeration():
    """Every order of two samples, for all sizes up to 8 against 8."""
    from itertools import combinations
    from math import comb

    from staysift.operators.stats import exact_u_p

    for n1 in range(1, 9):
        for n2 in range(1, 9):
            if comb(n1 + n2, n1) > 6500:
                continue
            us = [sum(c) - n1 * (n1 - 1) // 2 for c in combinations(range(n1 + n2), n1)]
            for u in range(n1 * n2 + 1):
                want = min(1.0, 2 * sum(x <= min(u, n1 * n2 - u) for x in us) / len(us))
                assert abs(exact_u_p(u, n1, n2) - want) < 1e-12
    assert abs(exact_u_p(0, 8, 100_000) - 2 / comb(100_008, 8)) < 1e-12 * 2 / comb(100_008, 8) + 1e-45


def test_exact_method_is_chosen_without_ties(spark):
    from pyspark.sql import functions as F

    from staysift.operators.stats import mann_whitney

    rows = [(float(3 * k % 29), k < 7) for k in range(20)]
    run = lambda data, **kw: mann_whitney(spark.createDataFrame(data, "v double, g boolean"), "v", F.col("g"), **kw).first()
    assert run(rows)["exact"] and not run(rows, method="asymptotic")["exact"]
    assert abs(run(rows)["p_value"] - run(rows, method="asymptotic")["p_value"]) < 0.05
    assert not run([*rows, (0.0, True)])["exact"]  # a tie
    assert not run([(float(k), k % 2 == 0) for k in range(30)])["exact"]  # large samples
    assert run([(1.0, True), (None, False)])["p_value"] is None or np.isnan(run([(1.0, True), (None, False)])["p_value"])
