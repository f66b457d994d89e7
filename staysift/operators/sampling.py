"""Reproducible sampling and train/test splits.

Randomness comes from ``md5(concat_ws('|', key..., seed))``: the same rows are
picked on any cluster size or partitioning (and in DuckDB). Selecting "the first
N by hash" uses bucketed ranks (``ranking.rows_before``), so neither the sample
nor a class ever has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staysift.operators.ranking import HASH_BITS, hash_key, hash_number, rows_before

# A label with at most this many distinct values is stratified on.
STRATIFY_MAX_CLASSES = 50


def _hashed(df: DataFrame, key_cols: Sequence[str], seed: int) -> DataFrame:
    h = hash_key(key_cols, seed)
    return df.withColumn("__h", h).withColumn("__hn", hash_number(F.col("__h")))


def exact_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the rows with the
    smallest seeded hash of their (unique) key. Distributed: every row learns its
    hash rank from bucket offsets, then a plain filter keeps rank < n."""
    ranked = rows_before(_hashed(df, key_cols, seed), ["__hn", "__h"], (), None, out_col="__rank", uniform_bits=HASH_BITS)
    return ranked.where(F.col("__rank") < n).drop("__h", "__hn", "__rank")


def class_count(df: DataFrame, label: str) -> int:
    """Distinct non-NULL labels (the stratification gate)."""
    return df.agg(F.countDistinct(label).alias("k")).first().k


def split_quotas(counts: DataFrame, label: str, test_share: float) -> DataFrame:
    """Test rows per class: ``floor(share * n_c)`` plus one for the classes with the
    largest remainders (ties by label) until the total equals
    ``ceil(share * n)``. ``counts`` holds one row per class (a small table)."""
    share = F.lit(float(test_share))
    total = F.sum("__n").over(Window.partitionBy(F.lit(1)))
    base = F.floor(F.col("__n") * share)
    rem = F.col("__n") * share - base
    q = counts.withColumn("__base", base).withColumn("__rem", rem)
    q = q.withColumn("__need", F.ceil(total * share) - F.sum("__base").over(Window.partitionBy(F.lit(1))))
    q = q.withColumn(
        "__pos", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("__rem"), F.asc(label))) - 1
    )
    return q.select(
        label, "__n", (F.col("__base") + (F.col("__pos") < F.col("__need")).cast("bigint")).alias("__quota")
    )


def with_split_flag(
    df: DataFrame,
    key_cols: Sequence[str],
    label: str | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Exact-size split as a column ``split`` ('train' / 'test'), one pass.

    ``ceil(share * n)`` test rows, stratified on ``label`` when it has at most 50
    classes. Within a class, the rows with the smallest seeded hash go to test.
    Disjoint and exhaustive by construction."""
    use_label = label if (stratify and label is not None and class_count(df, label) <= STRATIFY_MAX_CLASSES) else None
    group = "__cls"
    base = df.withColumn(group, F.col(use_label) if use_label else F.lit(0))
    counts = base.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    quotas = F.broadcast(split_quotas(counts, group, test_share))  # <= 50 classes
    hashed = _hashed(base, key_cols, seed)
    ranked = rows_before(hashed, ["__hn", "__h"], [group], None, out_col="__rank", uniform_bits=HASH_BITS)
    flagged = ranked.join(quotas, ranked[group].eqNullSafe(quotas[group]), "left").select(
        *[ranked[c] for c in ranked.columns], quotas["__quota"]
    )
    split = F.when(F.col("__rank") < F.col("__quota"), F.lit("test")).otherwise(F.lit("train"))
    return flagged.withColumn("split", split).drop(group, "__h", "__hn", "__rank", "__quota")


def train_test_split(
    df: DataFrame,
    key_cols: Sequence[str],
    label: str | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as two filters of ``with_split_flag`` (materialise the
    flagged frame first when both sides are used repeatedly)."""
    flagged = with_split_flag(df, key_cols, label, test_share, seed, stratify)
    return (
        flagged.where(F.col("split") == "train").drop("split"),
        flagged.where(F.col("split") == "test").drop("split"),
    )
