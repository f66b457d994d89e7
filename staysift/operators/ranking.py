"""Distributed prefix sums and ranks without a global window.

``row_number() over (order by x)`` with no partition moves every row into one
task. The helpers here split the order key into range buckets (boundaries from
``percentile_approx``, a bounded list), count each bucket (a small table), turn
those counts into per-bucket offsets, and run the window only inside
(group, bucket) partitions. Rank = bucket offset + rank within the bucket, exact.

Callers pass an order key that is unique within its group (a distinct-value
table, or a hash), so no bucket holds a hot duplicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256


def hash_key(cols: Sequence[Column | str], seed: int | str, *extra: Column | str) -> Column:
    """md5 of ``concat_ws('|', cols..., seed, extra...)``: a seeded, engine-independent
    pseudo-random order key (identical in DuckDB)."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    parts.append(F.lit(str(seed)))
    parts += [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in extra]
    return F.md5(F.concat_ws("|", *parts))


def hash_number(md5_hex: Column) -> Column:
    """First 60 bits of an md5 hex string as a non-negative BIGINT."""
    return F.conv(F.substring(md5_hex, 1, 15), 16, 10).cast("bigint")


HASH_BITS = 60
HASH_BUCKET_BITS = 12  # 4096 equal-width buckets over a uniform hash


def _bucketize(df: DataFrame, order_col: str, buckets: int, uniform_bits: int | None = None) -> DataFrame:
    if uniform_bits is not None:
        # a uniform hash needs no quantile pass: its top bits are balanced buckets
        shift = max(uniform_bits - HASH_BUCKET_BITS, 0)
        return df.withColumn("__b", F.shiftrightunsigned(F.col(order_col), shift).cast("double"))
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs, 10_000).alias("q")).first()
    bounds = sorted({float(b) for b in (row.q or []) if b is not None})
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) < 3:
        return df.withColumn("__b", F.lit(0.0))
    tmp = df.withColumn("__bk", F.col(order_col).cast("double"))
    out = Bucketizer(splits=splits, inputCol="__bk", outputCol="__b", handleInvalid="keep").transform(tmp)
    return out.drop("__bk")


def bucketed_prefix(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    weight: str | None = None,
    buckets: int = DEFAULT_BUCKETS,
    out_col: str = "__before",
    uniform_bits: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Like ``rows_before`` but keeps the bucket id ``__b`` on the rows and also
    returns the bucket table (group..., ``__b``, ``__off``, ``__bt``) so callers
    can locate a rank's bucket with a small join and then equi-join on
    (group, bucket) instead of on the group alone."""
    w = F.col(weight) if weight else F.lit(1)
    b = _bucketize(df, order_cols[0], buckets, uniform_bits).withColumn("__w", w.cast("bigint"))
    totals = b.groupBy(*group_cols, "__b").agg(F.sum("__w").alias("__bt"))
    offsets = totals.withColumn(
        "__off",
        F.sum("__bt").over(Window.partitionBy(*group_cols).orderBy("__b")) - F.col("__bt"),
    )
    within = Window.partitionBy(*group_cols, "__b").orderBy(*order_cols)
    b = b.withColumn("__in", F.sum("__w").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__w"))
    joined = b.join(offsets.drop("__bt"), [*group_cols, "__b"], "left")
    ranked = joined.withColumn(out_col, (F.col("__off") + F.col("__in")).cast("bigint")).drop(
        "__w", "__off", "__in"
    )
    return ranked, offsets


def rows_before(
    df: DataFrame,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    weight: str | None = None,
    buckets: int = DEFAULT_BUCKETS,
    out_col: str = "__before",
    uniform_bits: int | None = None,
) -> DataFrame:
    """Add ``out_col``: the total ``weight`` (or row count) of rows that come
    strictly before each row within its group, ordering by ``order_cols``.

    ``order_cols[0]`` must be numeric; it decides the range bucket. The order must
    be unique within a group (break ties with further ``order_cols``).
    ``uniform_bits`` marks ``order_cols[0]`` as a uniform non-negative hash of
    that many bits: buckets are then its top bits (no quantile pass).
    """
    ranked, _ = bucketed_prefix(df, order_cols, group_cols, weight, buckets, out_col, uniform_bits)
    return ranked.drop("__b")

