"""The subspace pigeonhole join against brute force."""

from collections import Counter

import numpy as np
import pytest

from staysift.llm import embedding_dedup
from staysift.llm.embedding_dedup import Blocks, near_duplicates


def brute(rows, cosine):
    """Rows of (id, links, component, kept); every row is a vector of its own."""
    length = Counter(
        len(v) for k, v in rows if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    )
    d = min(length, key=lambda n: (-length[n], n)) if length else 0
    valid = [
        i for i, (k, v) in enumerate(rows)
        if k is not None and v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, label = np.zeros(len(rows), dtype=int), np.arange(len(rows))
    if valid:
        x = np.array([rows[i][1] for i in valid], dtype=float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= cosine
        np.fill_diagonal(near, True)
        links[valid] = near.sum(axis=1) - 1
        order = np.argsort([rows[i][0] for i in valid], kind="stable")
        near = near[np.ix_(order, order)]
        own = np.arange(len(valid))
        while True:  # the smallest place reached, in the order of the ids
            least = np.array([own[row].min() for row in near])
            if (least == own).all():
                break
            own = least
        label[np.array(valid)[order]] = np.array(valid)[order][own]
    out = Counter()
    for i, (k, _) in enumerate(rows):
        least = rows[label[i]][0] if k is not None else None
        out[k, int(links[i]), least, k == least] += 1
    return out


def frame(spark, rows):
    full = [(k, v, 1, 2, 3, "x") for k, v in rows]
    return spark.createDataFrame(full, "vec_id bigint, embedding array<double>, block int, cell int, num int, home string").repartition(3)


def planted(rng, n, d):
    """Vectors in groups of near copies of all sizes, and alone."""
    rows, key = [], 0
    while len(rows) < n:
        centre = rng.standard_normal(d)
        noise = rng.choice([0.05, 0.2, 0.33, 0.5, 1.0])
        for _ in range(int(rng.choice([1, 1, 2, 3, 9, 60]))):
            key += int(rng.integers(1, 4))
            rows.append((key, ((centre + noise * rng.standard_normal(d)) * rng.choice([1e-6, 1.0, 50.0])).tolist()))
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize(("d", "cosine", "dims", "cells", "chunk"), [(64, 0.9, 8, 400, 100), (10, 0.8, 3, 200, 64), (3, 0.99, 8, 32_768, 65_536)])
def test_equals_brute_force(spark, d, cosine, dims, cells, chunk):
    rows = planted(np.random.default_rng(d), 900, d)
    got = near_duplicates(frame(spark, rows), cosine, dims, cells, chunk).collect()
    want = brute(rows, cosine)
    assert Counter(tuple(r) for r in got) == want
    assert sum(n > 0 for _, n, _, _ in want) > 100


def test_odd_rows(spark):
    one, two = [1.0, 2.0, 3.0, 0.0], [-1.0, 0.5, 0.0, 9.0]
    rows = [(7, one), (3, one), (3, one), (9, [2.0, 4.0, 6.0, 0.0]), (4, two), (4, one), (5, None), (6, []), (8, [0.0] * 4), (None, one)]
    rows += [(10, [1.0, None, 3.0, 0.0]), (11, [1.0, float("nan"), 3.0, 0.0]), (12, [float("inf"), 0.0, 0.0, 0.0]), (13, [1.0, 2.0])]
    rows += [(20, [1.0, 0.0, 0.0, 0.0]), (21, [0.9, 0.43588989435406736, 0.0, 0.0]), (22, [1e300, 1e-300, 0.0, 0.0]), (None, None)]
    rows += [(30, [-0.0, 0.0, 0.0, 1.0]), (31, [0.0, 0.0, 0.0, 1.0])]
    got = near_duplicates(frame(spark, rows), 0.9).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 0.9)
    assert near_duplicates(frame(spark, rows).limit(0)).count() == 0
    nothing = near_duplicates(frame(spark, [(1, None), (2, [0.0])])).collect()
    assert Counter(tuple(r) for r in nothing) == {(1, 0, 1, True): 1, (2, 0, 2, True): 1}


def test_one_common_vector(spark):
    """A third of all rows share a vector, another third are near copies of it."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(16)
    rows = [(k, centre.tolist()) for k in range(3000, 6000)]
    rows += [(k, (centre + 0.1 * rng.standard_normal(16)).tolist()) for k in range(6000, 7500)]
    rows += [(k, rng.standard_normal(16).tolist()) for k in range(1500)]
    got = near_duplicates(frame(spark, rows), 0.9, 4, 1000, 700).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 0.9)


def test_check_tables(spark):
    import pandas as pd

    for name in ("sf0.1", "check_h"):
        data = pd.read_parquet(f"/root/testdata/{name}/embeddings.parquet")
        rows = [(int(k), None if v is None else [float(x) for x in v]) for k, v in zip(data["vec_id"], data["embedding"], strict=True)]
        got = near_duplicates(spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")).collect()
        assert Counter(tuple(r) for r in got) == brute(rows, 0.9), name


def test_home_and_guest_cells():
    """Pairs within the share meet in the home cell of each; a vector has one home per block."""
    rng = np.random.default_rng(4)
    blocks = Blocks(12, 10**6, 0.9, 4, 100, 1)
    unit = blocks.unit(np.repeat(rng.standard_normal((60, 12)), 5, axis=0) + 0.15 * rng.standard_normal((300, 12)))
    x = blocks.rotated(unit)
    assert np.allclose(x @ x.T, unit @ unit.T, atol=1e-12)
    for block, (a, b) in enumerate(blocks.blocks):
        row, cell, home = blocks.cells(x, block)
        assert np.bincount(row[home]).tolist() == [1] * 300
        at = [set(cell[row == i].tolist()) for i in range(300)]
        own = dict(zip(row[home].tolist(), cell[home].tolist(), strict=True))
        d = ((x[:, None, a:b] - x[None, :, a:b]) ** 2).sum(axis=2)
        for i, j in zip(*np.nonzero(d <= blocks.shares[block]), strict=True):
            assert own[i] in at[j]
    assert embedding_dedup.NEAR < embedding_dedup.COARSE


def test_vectors_are_not_copied_to_meet(spark, monkeypatch):
    """Pairs of chunks read the written chunks again: no shuffle carries vectors per cell or pair."""
    plans = {}
    store = embedding_dedup.stored

    def stored(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name, **options)

    monkeypatch.setattr(embedding_dedup, "stored", stored)
    rows = planted(np.random.default_rng(3), 500, 16)
    got = near_duplicates(frame(spark, rows), 0.9, 4, 100, 64).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, 0.9)
    assert "Exchange" not in plans["dedup-links"]


def test_chunks_out_of_reach_do_not_meet():
    """Boxes further apart than the share in every block hold no links; near ones are compared."""
    rng = np.random.default_rng(5)
    blocks = Blocks(12, 1000, 0.9, 4, 100, 1)
    box = lambda x: np.stack((x.min(axis=0), x.max(axis=0)))
    far = near = 0
    for k in range(300):
        one, two = rng.standard_normal((2, 12))
        two = one + 0.2 * two if k % 2 else two
        a, b = (blocks.rotated(blocks.unit(x + 0.2 * rng.standard_normal((5, 12)))) for x in (one, two))
        linked, apart = (a @ b.T >= 0.9).any(), blocks.apart(box(a), box(b))
        far, near = far + apart, near + linked
        assert not (linked and apart)
    assert far and near
