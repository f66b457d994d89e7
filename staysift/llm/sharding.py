"""Uniform shuffle into shards of exact size, by a drawn communication matrix.

How many rows each input partition sends to each shard is drawn first: the counts of a
uniform shuffle follow the multivariate hypergeometric law with the partition sizes and
the shard sizes as margins. Given the counts, a partition permutes its rows locally and
deals them out in runs, rows travel once, and each shard permutes what it received.

Main path: DataFrame functions only. The driver sees one count per partition (partitions
are folded to a bounded number first) and draws the matrix.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysift.llm.common import ranked_in_groups, stored

MATRIX_CELLS = 65_536  # partitions x shards of the drawn matrix; more partitions are folded together


def draw_hypergeometric(rng: random.Random, good: int, bad: int, sample: int) -> int:
    """Successes among ``sample`` draws without replacement from ``good + bad``, by
    inversion outwards from the mode (exact up to double precision, any size)."""
    low, high = max(0, sample - bad), min(sample, good)
    if low == high:
        return low
    mode = min(high, max(low, (sample + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    p = math.exp(choose(good, mode) + choose(bad, sample - mode) - choose(good + bad, sample))
    u = rng.random() - p
    if u < 0:
        return mode
    up = down = mode
    p_up = p_down = p
    while True:
        moved = False
        if up < high:
            p_up *= (good - up) * (sample - up) / ((up + 1) * (bad - sample + up + 1))
            up += 1
            u -= p_up
            moved = p_up > 0
            if u < 0:
                return up
        if down > low:
            p_down *= down * (bad - sample + down) / ((good - down + 1) * (sample - down + 1))
            down -= 1
            u -= p_down
            moved = moved or p_down > 0
            if u < 0:
                return down
        if not moved:  # rounding left a little of u: its place is the far tail
            return mode


def communication_matrix(sizes: list[int], targets: list[int], seed: int) -> list[list[int]]:
    """Rows sent from each partition to each shard: a uniform draw among all shuffles.
    Row sums are ``sizes``, column sums ``targets``."""
    rng = random.Random(seed)
    left = list(targets)
    matrix = []
    for size in sizes:
        row, wanted, others = [], size, sum(left)
        for s, room in enumerate(left):
            others -= room
            got = draw_hypergeometric(rng, room, others, wanted) if wanted else 0
            row.append(got)
            wanted -= got
            left[s] -= got
        matrix.append(row)
    return matrix


def shuffle_into_shards(docs: DataFrame, n_shards: int, seed: int = 42, rows_per_slice: int = 100_000) -> DataFrame:
    """Deal all rows of ``docs`` uniformly into ``n_shards`` shards whose row counts are
    at most one apart; adds ``shard`` (int) and ``slot`` (long, gapless from 0 within the
    shard, itself a uniform permutation).

    The randomness of the two permutations is a seeded 64-bit hash of the whole row, so a
    retried task repeats it. Wholly equal rows tie: each still gets a place of its own.
    Nulls in any column are ordinary values. Input columns named ``shard`` or ``slot`` are
    replaced. An empty table gives no rows; fewer rows than shards leave shards empty.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    docs = docs.drop("shard", "slot")
    folded = max(1, MATRIX_CELLS // n_shards)
    staged = stored(
        docs.withColumn("__part", F.spark_partition_id() % folded).withColumn(
            "__local", F.xxhash64(F.lit(f"local-{seed}"), *docs.columns)
        ),
        "shard-input",
    )
    counts = sorted((r["__part"], r["n"]) for r in staged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    targets = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([n for _, n in counts], targets, seed)
    rows = []
    for (part, _), sent in zip(counts, matrix, strict=True):
        ends, at = [], 0
        for n in sent:
            at += n
            ends.append(at)
        rows.append({"p": part, "e": ends})
    deal = (
        docs.sparkSession.range(1)
        .select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<p:int,e:array<bigint>>>")).alias("r"))
        .select(F.col("r.p").alias("__part"), F.col("r.e").alias("__ends"))
    )
    local = ranked_in_groups(staged, ["__part"], "__local", "__rank", total, rows_per_slice)
    # the matrix has at most MATRIX_CELLS cells, whatever the input
    dealt = local.join(F.broadcast(deal), "__part").withColumn(
        "shard", F.size(F.filter("__ends", lambda e: e <= F.col("__rank"))).cast("int")
    )
    placed = dealt.withColumn("__order", F.xxhash64(F.lit(f"shard-{seed}"), *docs.columns))
    out = ranked_in_groups(placed, ["shard"], "__order", "slot", total, rows_per_slice * n_shards)
    return out.select(*docs.columns, "shard", "slot")
