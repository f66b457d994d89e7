"""The permutation test's join of packed blocks, against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staysift.operators import permutation


def target(k, a, b, n, prime):
    k = (a * k + b) % prime
    while k >= n:
        k = (a * k + b) % prime
    return k


@pytest.mark.parametrize("n,prime", [(1000, 1009), (1009, 1009), (90, 4_294_967_311), (90, 6_000_000_000_037)])
def test_permuted_index_equals_plain_arithmetic(n, prime):
    if prime > 10_000:  # far over n: a place among the first numbers of a large range
        n = prime
    a, b = permutation.affine_map(42, 3, prime)
    k = np.arange(90, dtype=np.uint64)
    assert permutation.permuted_index(k, a, b, n, prime).tolist() == [target(int(i), a, b, n, prime) for i in k]


def block_sums(spark, n, maps, prime, hole=None):
    """Sums by blocks, and by a plain loop, of two weights and a label that is NULL in places."""
    rng = np.random.default_rng(5)
    rows = [
        (k, None if hole and k % hole == 0 else float(y), None if hole and k % 11 == 0 else float(u), float(v))
        for k, (y, u, v) in enumerate(rng.normal(size=(n, 3)))
    ]
    base = spark.createDataFrame(rows, "__k bigint, __y double, w_a double, w_b double").repartition(5)
    weights = permutation.packed_blocks(base, ["w_a", "w_b"], permutation.WEIGHT_BLOCK_ROWS, "test-weights")
    labels = permutation.packed_blocks(base, ["__y"], permutation.LABEL_BLOCK_ROWS, "test-labels")
    found = permutation.permuted_sums(weights, labels, 2, maps, n, prime)
    want = {}
    for m, (a, b) in enumerate(maps):
        sums = []
        for i in (2, 3):
            pairs = [(rows[k][i], rows[target(k, a, b, n, prime)][1]) for k in range(n)]
            sums.append(sum(w * y for w, y in pairs if w is not None and y is not None))
        want[m] = sums
    return found, want, labels.count(), weights.count()


@pytest.mark.parametrize("hole", [None, 7])
def test_blocks_add_up_to_whole_permutations(spark, monkeypatch, hole):
    monkeypatch.setattr(permutation, "WEIGHT_BLOCK_ROWS", 64)
    monkeypatch.setattr(permutation, "LABEL_BLOCK_ROWS", 150)
    n = 500
    prime = permutation.next_prime(n)
    maps = [permutation.affine_map(42, m, prime) for m in range(12)]
    found, want, n_labels, n_weights = block_sums(spark, n, maps, prime, hole)
    assert (n_labels, n_weights) == (4, 8)
    got = {r.perm: [r.s0, r.s1] for r in found.collect()}
    assert set(got) == set(want)
    for m in want:
        assert got[m] == pytest.approx(want[m], rel=1e-9, abs=1e-9)


def test_all_null_labels_give_null_sums(spark):
    base = spark.range(20).select(F.col("id").alias("__k"), F.lit(None).cast("double").alias("__y"), F.lit(1.0).alias("w_a"))
    weights = permutation.packed_blocks(base, ["w_a"], permutation.WEIGHT_BLOCK_ROWS, "test-weights")
    labels = permutation.packed_blocks(base, ["__y"], permutation.LABEL_BLOCK_ROWS, "test-labels")
    assert [r.s0 for r in permutation.permuted_sums(weights, labels, 1, [(3, 1), (5, 2)], 20, 23).collect()] == [None, None]


def test_no_row_is_shuffled_for_a_permutation(spark, monkeypatch):
    """The exchange before the sums gets one row per permutation and pair of blocks."""
    monkeypatch.setattr(permutation, "WEIGHT_BLOCK_ROWS", 64)
    monkeypatch.setattr(permutation, "LABEL_BLOCK_ROWS", 150)
    maps = [permutation.affine_map(42, m, 503) for m in range(30)]
    found, _, _, _ = block_sums(spark, 500, maps, 503)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert found.count() == len(maps)
