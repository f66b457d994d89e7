"""Order statistics by histogram narrowing against sorting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staysift.operators import explore, selection

INF = float("inf")


def groups():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.standard_normal(5000),
        "steep": np.exp(rng.uniform(-600, 600, 3000)),
        "equal": np.full(800, 2.5),
        "few": rng.integers(0, 3, 2000).astype(float),
        "one": np.array([-7.25]),
        "two": np.array([1.0, 2.0]),
        "wide": np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 3.0]),
        "ends": np.array([-INF, -INF, 1.0, 2.0, 3.0, INF]),
        "close": 1.0 + np.arange(300) * 2.0**-52,
        "hot": np.concatenate((np.zeros(3000), rng.standard_normal(200))),
    }


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, float(v)) for g, vs in groups().items() for v in vs]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def test_order_statistics_equal_sorted_values(spark, frame):
    rng = np.random.default_rng(1)
    ranks = [(g, int(k)) for g, vs in groups().items() for k in {0, len(vs) - 1, *rng.integers(0, len(vs), 5).tolist()}]
    got = selection.order_statistics(frame, ["g"], "v", spark.createDataFrame(ranks, "g string, k bigint")).collect()
    assert {(r["g"], r["k"]): r["v"] for r in got} == {(g, k): float(np.sort(groups()[g])[k]) for g, k in ranks}
    assert len(got) == len(ranks)


def test_quantiles_equal_numpy(frame):
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["q"]): r["quantile"] for r in explore.exact_quantiles(frame.where("g NOT IN ('ends', 'wide')"), ["g"], "v", qs).collect()}
    for g, vs in groups().items():
        if g not in ("ends", "wide"):
            for q in qs:
                assert np.isclose(got[g, q], np.quantile(vs, q), rtol=1e-12, atol=0), (g, q)


def test_without_groups_and_missing_values(spark):
    rows = [(float(k % 50), "a") for k in range(1001)] + [(None, "a"), (float("nan"), "a"), (3.0, None)]
    df = spark.createDataFrame(rows, "v double, g string")
    got = {r["q"]: r["quantile"] for r in explore.exact_quantiles(df, [], "v", [0.5, 0.75]).collect()}
    vs = [k % 50 for k in range(1001)] + [3.0]
    assert got == {0.5: np.quantile(vs, 0.5), 0.75: np.quantile(vs, 0.75)}
    assert explore.exact_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_no_window_and_no_shuffle_of_values(spark, frame, monkeypatch):
    """The counting step sends partial counts only, and no step sorts the rows."""
    plans = []
    real = selection.written

    def seen(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, tag)

    monkeypatch.setattr(selection, "written", seen)
    selection.quantiles(frame.where(F.col("g") == "normal"), ["g"], "v", [0.5]).collect()
    narrowing = [p for p in plans if "Window" in p]
    assert narrowing
    for plan in narrowing:
        below = plan[plan.index("Window") :]
        assert "HashAggregate" in below.split("Window")[1]  # the window stands on aggregated buckets
        assert below.count("partial_count") >= 1
