"""Permutation test of regression coefficients without refitting.

For least squares with an intercept, the coefficient of feature f is linear in
the labels: beta_f = sum_i w_i * y_i with w_i = x_i . g_f, where g_f is row f of
pinv(X'X) (X with the intercept column). So a permuted fit is one distributed dot
product, and the only driver-side step is the pseudo-inverse of X'X, whose size
is bounded by the feature count (the one-hot caps), not by the rows.

Rows are numbered once, in the order of a seeded md5 (bucketed ranks, no global
window). Permutation m then is arithmetic: row k receives the label of row
``(a_m * k + b_m) mod p``, with p the next prime, applied again while that is not a row
number. Such maps are bijections, and on p rows they move every pair of rows to every
pair of places equally often, so the null distribution has the mean and the variance of
uniform permutations. All permutations share one join of packed blocks of row numbers, so the
bytes moved do not grow with the number of permutations.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.operators.ranking import HASH_BITS, hash_key, hash_number, rows_before
from staysift.operators.stats import null_summary
from staysift.session import bounded_batches, written

# A permutation joins rows by number: weights and labels are packed into blocks of consecutive
# numbers, and every pair of blocks is joined. These are the rows of a block.
WEIGHT_BLOCK_ROWS = 1 << 18
LABEL_BLOCK_ROWS = 1 << 22


def next_prime(n: int) -> int:
    """The smallest prime that is at least ``n``."""
    while n < 2 or any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def affine_map(seed: int | str, m: int, prime: int) -> tuple[int, int]:
    """Multiplier (1 to p - 1) and offset (0 to p - 1) of permutation ``m``."""
    number = lambda part: int(hashlib.md5(f"{seed}|{m}|{part}".encode()).hexdigest()[:15], 16)
    return number("a") % (prime - 1) + 1, number("b") % prime


def permuted_index(k: np.ndarray, a: int, b: int, n: int, prime: int) -> np.ndarray:
    """``(a * k + b) mod prime``, applied again while the result is ``n`` or more (at most
    ``prime - n`` times: the numbers from ``n`` on are that many)."""

    def step(x: np.ndarray) -> np.ndarray:
        if prime >= 1 << 32:  # the product must fit
            return ((x.astype(object) * a + b) % prime).astype(np.uint64)
        moved = x * np.uint64(a) + np.uint64(b)
        return moved - moved // np.uint64(prime) * np.uint64(prime)

    out = step(k.astype(np.uint64))
    over = np.flatnonzero(out >= n) if prime > n else ()
    while len(over):
        out[over] = step(out[over])
        over = over[out[over] >= n]
    return out


def _nonzeros(features: str) -> F.Column:
    """(i, x) pairs of a vector's non-zero entries, with the intercept at i = 0."""
    arr = F.concat(F.array(F.lit(1.0)), vector_to_array(F.col(features)))
    pairs = F.transform(arr, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    return F.filter(pairs, lambda s: s["x"] != 0.0)


def gram_matrix(df: DataFrame, features: str = "features") -> np.ndarray:
    """X'X (intercept first) from per-row outer products of the non-zeros,
    summed by (i, j) with map-side combining; returns a dense (p+1)^2 array."""
    width = len(df.select(features).first()[0]) + 1
    nz = df.select(_nonzeros(features).alias("nz"))
    a = nz.select(F.explode("nz").alias("a"), "nz")
    pairs = a.select("a", F.explode("nz").alias("b"))
    sums = pairs.groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(
        F.sum(F.col("a.x") * F.col("b.x")).alias("v")
    )
    g = np.zeros((width, width))
    for r in sums.collect():  # at most (p+1)^2 rows, bounded by the feature count
        g[r.i, r.j] = r.v
    return g


def coefficient_weights(
    df: DataFrame, feature_names: Sequence[str], tested: Sequence[str], features: str = "features"
) -> DataFrame:
    """Adds ``w_<feature>`` for each tested feature: beta_f = sum(w * y)."""
    names = list(feature_names)
    g = gram_matrix(df, features)
    pinv = np.linalg.pinv(g, rcond=1e-10, hermitian=True)
    out = df.withColumn("__nz", _nonzeros(features))
    for f in tested:
        if f not in names:
            raise KeyError(f"the model has no feature {f!r}; it has {', '.join(names)}")
        row = pinv[names.index(f) + 1]
        lit = F.array(*[F.lit(float(v)) for v in row])
        w = F.aggregate("__nz", F.lit(0.0), lambda acc, s: acc + s["x"] * F.element_at(lit, s["i"] + 1))
        out = out.withColumn(f"w_{f}", w)
    return out.drop("__nz")


def packed_blocks(base: DataFrame, columns: Sequence[str], rows: int, tag: str) -> DataFrame:
    """``base`` with ``rows`` consecutive row numbers ``__k`` (from 0, gapless) in one row: block
    ``at``, then for each column the doubles in row order and, where any is NULL, a byte per row
    that is 0 for a NULL. Written, as every block is read once for each block it is joined with."""
    names = [f"{kind}{i}" for i in range(len(columns)) for kind in ("v", "ok")]

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("__k")
        out = [pa.array([group.column("__k")[0].as_py() // rows], pa.int64())]
        for c in columns:
            col = group.column(c)
            ok = col.is_valid().to_numpy().astype(np.uint8).tobytes() if col.null_count else b""
            out += [pa.array([v], pa.binary()) for v in (col.fill_null(0.0).to_numpy().tobytes(), ok)]
        return pa.Table.from_arrays(out, ["at", *names])

    cut = base.select("__k", *columns, F.floor(F.col("__k") / rows).alias("__block"))
    made = cut.groupBy("__block").applyInArrow(
        lambda group: pack(group.drop_columns("__block")), "at bigint, " + ", ".join(f"{n} binary" for n in names)
    )
    return written(made, tag)


def permuted_sums(
    weights: DataFrame, labels: DataFrame, n_features: int, maps: Sequence[tuple[int, int]], n_rows: int, prime: int
) -> DataFrame:
    """``perm`` (from 0) and the sum of weight times permuted label of each feature, ``s0`` and
    on, under each of the ``maps``. Every pair of blocks (see ``packed_blocks``) is one row of a
    cross join and adds the products of its own rows, so nothing is shuffled for each
    permutation, and a task holds two blocks at a time. NULL products are left out."""

    w_rows, y_rows = WEIGHT_BLOCK_ROWS, LABEL_BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), dtype=kind)  # noqa: E731, B023
                w = np.stack([part(f"v{i}", float) for i in range(n_features)])
                w_ok = [part(f"ok{i}", np.uint8) for i in range(n_features)]
                y, y_ok = part("y", float), part("y_ok", np.uint8)
                k = np.arange(w.shape[1], dtype=np.uint64) + np.uint64(batch.column("at")[row].as_py() * w_rows)
                first = np.uint64(batch.column("y_at")[row].as_py() * y_rows)
                sums: list[list[float | None]] = [[] for _ in range(n_features)]
                for a, b in maps:
                    place = permuted_index(k, a, b, n_rows, prime) - first  # unsigned: a smaller number wraps
                    here = slice(None)
                    if len(y) < n_rows:
                        here = np.flatnonzero(place < len(y))
                        place = place[here]
                    if len(y_ok):
                        known = np.flatnonzero(y_ok[place])
                        here, place = known if isinstance(here, slice) else here[known], place[known]
                    value = y[place]
                    for i, out in enumerate(sums):
                        own, v = w[i][here], value
                        if len(w_ok[i]):
                            keep = w_ok[i][here] > 0
                            own, v = own[keep], v[keep]
                        out.append(float(np.dot(own, v)) if len(v) else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(maps)), pa.int32())] + [pa.array(s, pa.float64()) for s in sums],
                    ["perm", *[f"s{i}" for i in range(n_features)]],
                )

    right = labels.select(F.col("at").alias("y_at"), F.col("v0").alias("y"), F.col("ok0").alias("y_ok"))
    sums = [f"s{i}" for i in range(n_features)]
    # tasks read their blocks themselves (no broadcast through the driver), one pair in an Arrow batch
    pairs = bounded_batches(weights.crossJoin(right.hint("shuffle_replicate_nl")))
    found = pairs.mapInArrow(run, "perm int, " + ", ".join(f"{s} double" for s in sums))
    return found.groupBy("perm").agg(*[F.sum(s).alias(s) for s in sums])


def permutation_test(
    df: DataFrame,
    key_cols: Sequence[str],
    feature_names: Sequence[str],
    tested: Sequence[str],
    n_permutations: int = 400,
    seed: int = 42,
    features: str = "features",
    label: str = "label",
    batch_size: int | None = None,
) -> DataFrame:
    """Observed coefficients, null distribution summary and empirical two-sided
    p-value per tested feature (one row per feature). Permutations run in
    jobs of ``batch_size`` (``None``: all in one)."""
    weighted = coefficient_weights(df, feature_names, tested, features)
    wcols = [f"w_{f}" for f in tested]
    hashed = weighted.select(
        *key_cols, F.col(label).cast("double").alias("__y"), *wcols, hash_number(hash_key(key_cols, seed)).alias("__hn")
    )
    # rows are numbered once, in the order of their hash (the row key breaks ties)
    numbered = rows_before(hashed, ["__hn", *key_cols], (), None, out_col="__k", uniform_bits=HASH_BITS)
    base = written(numbered.select("__k", "__y", *wcols), "permutation-base")
    n_rows = base.count()
    prime = next_prime(max(n_rows, 2))

    observed = base.select(
        F.explode(F.array(*[
            F.struct(F.lit(f).alias("feature"), (F.col(f"w_{f}") * F.col("__y")).alias("c")) for f in tested
        ])).alias("r")
    ).groupBy("r.feature").agg(F.sum("r.c").alias("coef"))

    weights = packed_blocks(base, wcols, WEIGHT_BLOCK_ROWS, "permutation-weights")
    labels = packed_blocks(base, ["__y"], LABEL_BLOCK_ROWS, "permutation-labels")
    rows = []  # of the coefficients: n_permutations * features numbers
    for first in range(0, n_permutations, batch_size or max(1, n_permutations)):
        last = min(n_permutations, first + (batch_size or n_permutations))
        maps = [affine_map(seed, m, prime) for m in range(first, last)]
        for r in permuted_sums(weights, labels, len(tested), maps, n_rows, prime).collect():
            rows += [(first + r["perm"], f, r[f"s{i}"]) for i, f in enumerate(tested)]
    null_long = base.sparkSession.createDataFrame(rows, "perm int, feature string, coef double")
    out = null_summary(null_long, observed, "feature", "coef")
    return out.withColumn("null_hypothesis", F.concat(F.lit("Coefficient for "), F.col("feature"), F.lit(" equals 0")))
