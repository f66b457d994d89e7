"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by a few random projections, each cut into cells. A query
visits the buckets of a table in the order of their estimated probability to hold a
near neighbour, until the probabilities add up to the wanted success; the candidates
of all tables are merged and ranked by the exact measure.

Largest inner products become nearest neighbours of the p-stable (Euclidean) kind by
scaling vectors by the largest norm and adding a coordinate that completes them to unit
length; queries have zero there. How a neighbour's projection follows its query's
(slope and spread) is estimated on a bounded sample of queries.

Scale: vectors travel once per table, in blocks of whole buckets; a block is scored by
matrix products against the queries that probe it. Blocks that grow beyond a size (one
very common vector) are split by a hash of the id, as are the queries of a block, and
each block returns at most k rows per query.
"""

from __future__ import annotations

import heapq
from math import ceil, erf, log2, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staysift.llm.common import stored


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vec)`` with double components, without NULL ids and vectors that are NULL,
    zero, hold NULL or non-finite components, or differ from the commonest length."""
    v = F.col("vec")
    df = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = df.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    sizes = df.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return df.where(F.size(v) == (sizes[0]["d"] if sizes else 0))


class Tables:
    """Random projections of ``n_tables`` tables and the estimate that orders probes."""

    def __init__(self, dim: int, bits: int, n_tables: int, max_norm: float, success: float, seed: int):
        rng = np.random.default_rng(seed)
        self.bits, self.n_tables, self.max_norm = bits, n_tables, max_norm
        self.a = rng.standard_normal((n_tables, dim + 1, bits))
        self.a /= np.linalg.norm(self.a, axis=1, keepdims=True)
        self.width = 2.0 / sqrt(dim + 1)  # of a cell, in deviations of a unit vector's projection
        self.shift = rng.uniform(0, self.width, (n_tables, bits))
        self.slope, self.spread = 1.0, 1.0 / sqrt(dim + 1)
        # each table alone must succeed this often for all to reach the wanted success
        self.each = 1 - (1 - success) ** (1 / n_tables)

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Projections, tables x rows x bits."""
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            full = np.hstack((unit, np.zeros((len(x), 1))))
        else:
            scaled = x / self.max_norm
            rest = np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(axis=1, keepdims=True)))
            full = np.hstack((scaled, rest))
        return np.einsum("nd,tdk->tnk", full, self.a)

    def cells(self, projected: np.ndarray) -> np.ndarray:
        return np.floor((projected + self.shift[:, None, :]) / self.width).astype(np.int64)

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        """One number per bucket: cell numbers (bounded) as digits."""
        code = np.zeros(cells.shape[:-1], dtype=np.int64)
        for k in range(self.bits):
            code = code * 64 + np.clip(cells[..., k] + 32, 0, 63)
        return code

    def fit_probes(self, queries: np.ndarray, near: list[np.ndarray]) -> None:
        """Slope and spread of neighbours' projections given their query's."""
        q = np.concatenate([np.repeat(self.project(x[None], True), len(n), axis=1) for x, n in zip(queries, near)], axis=1).ravel()
        n = np.concatenate([self.project(n, False) for n in near], axis=1).ravel()
        self.slope = float((q * n).sum() / max(1e-12, (q * q).sum()))
        self.spread = max(1e-6, float(np.std(n - self.slope * q)))

    def probes(self, at: np.ndarray, table: int) -> list[int]:
        """Buckets of one table for a projected query, likeliest first, until their
        probabilities add up to the wanted success."""
        if not self.bits:
            return [0]
        options = []
        for k in range(self.bits):
            centre, spread = self.slope * at[k] + self.shift[table, k], self.spread
            low = int(np.floor((centre - 5 * spread) / self.width))
            high = int(np.floor((centre + 5 * spread) / self.width))
            edge = [0.5 * (1 + erf((c * self.width - centre) / (spread * sqrt(2)))) for c in range(low, high + 2)]
            edge[0], edge[-1] = 0.0, 1.0
            cells = [(edge[i + 1] - edge[i], low + i) for i in range(high - low + 1)]
            options.append(sorted(cells, reverse=True))
        best = tuple([0] * self.bits)
        chance = lambda pick: float(np.prod([options[k][i][0] for k, i in enumerate(pick)]))
        heap, seen, found, covered = [(-chance(best), best)], {best}, [], 0.0
        while heap and covered < self.each:
            p, pick = heapq.heappop(heap)
            covered -= p
            found.append([options[k][i][1] for k, i in enumerate(pick)])
            for k in range(self.bits):
                nxt = pick[:k] + (pick[k] + 1,) + pick[k + 1 :]
                if nxt[k] < len(options[k]) and nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (-chance(nxt), nxt))
        return list(dict.fromkeys(self.bucket(np.array(found)).tolist()))


def _top_in_block(data: pd.DataFrame, asks: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of a block for each query among the buckets that it probes (NULL: all)."""
    ids = data["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.stack(data["vec"].to_numpy())[order].astype(float)
    names, place = np.unique(data["bucket"].to_numpy()[order], return_inverse=True)
    out = []
    for start in range(0, len(asks), 256):
        part = asks.iloc[start : start + 256]
        own = part["query_id"].to_numpy()
        score = np.stack(part["vec"].to_numpy()).astype(float) @ x.T
        open_ = np.zeros((len(part), len(names)), dtype=bool)
        for i, buckets in enumerate(part["buckets"]):
            open_[i] = True if buckets is None else np.isin(names, buckets)
        score[~open_[:, place]] = -np.inf
        score[own[:, None] == ids[None, :]] = -np.inf
        n = min(k, len(ids))
        bar = np.partition(score, len(ids) - n, axis=1)[:, len(ids) - n]
        for i in range(len(part)):
            # all that reach the bar, so that ties go to the smaller id
            hit = np.flatnonzero((score[i] >= bar[i]) & (score[i] > -np.inf))
            hit = hit[np.argsort(-score[i][hit], kind="stable")][:k]
            out.append((own[i], ids[hit], score[i][hit]))
    sizes = [len(o[1]) for o in out]
    return pd.DataFrame(
        {
            "query_id": np.repeat([o[0] for o in out], sizes),
            "vec_id": np.concatenate([o[1] for o in out]) if out else [],
            "score": np.concatenate([o[2] for o in out]) if out else [],
        }
    )


def _block_search(data: DataFrame, asks: DataFrame, k: int, data_rows: int, ask_rows: int) -> DataFrame:
    """Score blocks: ``data`` (tab, grp, id, vec, bucket), ``asks`` (tab, grp, query_id, vec,
    buckets). Both sides of a (tab, grp) are split to at most about the given rows."""
    by = ["tab", "grp"]
    sizes = data.groupBy(*by).agg(F.count(F.lit(1)).alias("nd")).join(
        asks.groupBy(*by).agg(F.count(F.lit(1)).alias("nq")), by
    ).select(*by, F.ceil(F.col("nd") / data_rows).alias("sd"), F.ceil(F.col("nq") / ask_rows).alias("sq"))
    data = (
        data.join(sizes, by)
        .withColumn("ds", F.pmod(F.xxhash64("id"), F.col("sd")))
        .withColumn("qs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("sq") - 1)))
    )
    asks = (
        asks.join(sizes, by)
        .withColumn("qs", F.pmod(F.xxhash64("query_id"), F.col("sq")))
        .withColumn("ds", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("sd") - 1)))
    )
    keys = [*by, "ds", "qs"]

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        return _top_in_block(left, right, k)

    found = (
        data.select(*keys, "id", "vec", "bucket")
        .groupBy(*keys)
        .cogroup(asks.select(*keys, "query_id", "vec", "buckets").groupBy(*keys))
        .applyInPandas(best, "query_id bigint, vec_id bigint, score double")
    )
    # tables overlap: a candidate counts once; at most k rows per query and block
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    n_tables: int = 2,
    success: float = 0.97,
    rows_per_bucket: int = 800,
    rows_per_block: int = 16_384,
    queries_per_block: int = 16_384,
    fit_queries: int = 64,
    fit_rows: int = 20_000,
    seed: int = 42,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` largest inner products found for each query among all other rows:
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id.

    All rows are indexed. The number of projections grows with the logarithm of the rows,
    so buckets keep about ``rows_per_bucket`` rows. Probe order is estimated on at most
    ``fit_queries`` vectors against at most ``fit_rows`` others. A query that finds fewer
    than ``k`` candidates is answered exactly, against all rows in blocks.

    Invalid vectors (see :func:`valid_vectors`) take no part on either side. Rows with one
    id are one candidate (the best score of its vectors); a query id repeated with other
    vectors is answered by the best of them. Other columns are not read; empty inputs give
    no rows.
    """
    x = stored(valid_vectors(vectors, id_col, vector_col), "ann-vectors")
    q = valid_vectors(queries, id_col, vector_col)
    spark = x.sparkSession
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    facts = x.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("m"), F.max(F.size("vec")).alias("d")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    bits = max(0, min(10, round(log2(max(1.0, facts["n"] / rows_per_bucket)))))
    tables = Tables(facts["d"], bits, n_tables, float(facts["m"]) * (1 + 1e-12), success, seed)
    if bits:
        rate = min(1.0, 1.1 * fit_rows / facts["n"])
        share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
        sample = x.where(share < rate).limit(2 * fit_rows).toPandas().sort_values("id")
        known = np.stack(sample["vec"].to_numpy())
        chosen = known[:: max(1, len(known) // fit_queries)][:fit_queries]
        near = []
        for v in chosen:
            s = known @ v
            s[(known == v).all(axis=1)] = -np.inf
            near.append(known[np.argsort(-s)[: max(1, round(k * len(known) / facts["n"]))]])
        tables.fit_probes(chosen, near)
    groups = max(1, ceil(facts["n"] / rows_per_block))
    n_tables = n_tables if bits else 1
    shared = spark.sparkContext.broadcast(tables)

    def group_of(buckets: np.ndarray) -> np.ndarray:
        mixed = buckets.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int32)

    def index(frames):
        t = shared.value
        for f in frames:
            if len(f):
                buckets = t.bucket(t.cells(t.project(np.stack(f["vec"].to_numpy()), False)))
                for tab in range(n_tables):
                    yield f.assign(tab=np.int32(tab), bucket=buckets[tab], grp=group_of(buckets[tab]))[
                        ["tab", "grp", "id", "vec", "bucket"]
                    ]

    def probe(frames):
        t = shared.value
        for f in frames:
            rows = []
            if len(f):
                at = t.project(np.stack(f["vec"].to_numpy()), True)
                for tab in range(n_tables):
                    for i, (key, vec) in enumerate(zip(f["id"], f["vec"], strict=True)):
                        buckets = np.array(t.probes(at[tab, i], tab), dtype=np.int64)
                        for g, own in pd.Series(buckets).groupby(group_of(buckets)):
                            rows.append((tab, int(g), key, vec, own.tolist()))
            if rows:
                yield pd.DataFrame(rows, columns=["tab", "grp", "query_id", "vec", "buckets"])

    kind = x.schema["id"].dataType.simpleString()
    data = stored(
        x.mapInPandas(index, f"tab int, grp int, id {kind}, vec array<double>, bucket bigint"), "ann-index"
    )
    asks = stored(
        q.mapInPandas(probe, f"tab int, grp int, query_id {kind}, vec array<double>, buckets array<bigint>"), "ann-probes"
    )
    found = stored(_block_search(data, asks, k, rows_per_block, queries_per_block), "ann-found")
    # too few candidates in the probed buckets: these queries look at everything
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, facts["n"] - 1))
    short = q.join(counts.select(F.col("query_id").alias("id")), "id", "left_anti")
    everything = data.where("tab = 0")
    if facts["n"] > 1 and not short.isEmpty():
        every = short.select(
            F.lit(0).alias("tab"),
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"),
            F.col("id").alias("query_id"),
            "vec",
            F.lit(None).cast("array<bigint>").alias("buckets"),
        )
        again = _block_search(everything, every, k, rows_per_block, queries_per_block)
        found = found.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
    return found
