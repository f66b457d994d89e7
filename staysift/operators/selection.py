"""Exact order statistics by histogram narrowing: nothing is sorted.

Each wanted rank keeps the interval of values that holds it. A round counts the rows inside
the open intervals in equal-width buckets, moves each rank to its bucket, and shrinks the
interval to the least and greatest value met there; a rank is found when both are equal. The
rows cross no shuffle: tasks send partial counts of at most ``BUCKETS`` buckets per interval. On
smooth data a round leaves one row in a few thousand, so two or three rounds do; equal values
end a rank at once, however many there are. (Intervals of more groups than a broadcast allows
are joined by shuffle.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staysift.operators.lookup import checked_broadcast
from staysift.session import written

BUCKETS = 4096
_FINITE = 1.7e308


def _bucket(v: Column, lo: Column, hi: Column, first: bool) -> Column:
    """0 for the least value, ``BUCKETS + 1`` for the greatest, equal widths between. Halves keep
    the width of the widest interval finite, and infinite ends have buckets of their own. After
    the first round, an interval over several magnitudes is cut on a signed log scale."""
    low, high = F.greatest(lo, F.lit(-_FINITE)), F.least(hi, F.lit(_FINITE))
    even = F.try_divide(v / 2 - low / 2, high / 2 - low / 2)
    if not first:
        far = F.greatest(F.abs(low), F.abs(high)) / 16 > F.least(F.abs(low), F.abs(high))
        scale = lambda x: F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log(F.abs(x)) + 800))
        logs = F.try_divide(scale(v) - scale(low), scale(high) - scale(low))
        even = F.when(far | (F.signum(low) * F.signum(high) < 0), logs).otherwise(even)
    inner = F.least(F.floor(F.greatest(F.coalesce(even, F.lit(0.0)), F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)) + 1
    return F.when(v == lo, 0).when(v == hi, BUCKETS + 1).otherwise(inner)


def order_statistics(rows: DataFrame, group: Sequence[str], value: str, ranks: DataFrame) -> DataFrame:
    """The values of given ranks: ``(group..., k, v)`` for ``ranks`` ``(group..., k)`` with
    distinct k from 0 to the group's rows less one. ``rows`` holds no NULL or NaN; it is read once
    per round, so it should be a scan of a written table."""
    if not group:
        one = {"__all": F.lit(0)}
        return order_statistics(rows.withColumns(one), ["__all"], value, ranks.withColumns(one)).drop("__all")
    group, v = list(group), F.col(value)
    facts = rows.groupBy(*group).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    state = written(ranks.join(facts, group).withColumn("before", F.lit(0).cast("bigint")), "ranks")
    found, first = None, True
    while True:
        done = state.where("lo = hi").select(*group, "k", F.col("lo").alias("v"))
        found = done if found is None else found.unionByName(done)
        still = state.where("lo < hi")
        if still.isEmpty():
            return found
        spans = checked_broadcast(still.select(*group, "lo", "hi").distinct())
        inside = (v >= F.col("lo")) & (v <= F.col("hi"))
        counted = rows.join(spans, group).where(inside).groupBy(*group, "lo", "hi", _bucket(v, F.col("lo"), F.col("hi"), first).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(v).alias("least"), F.max(v).alias("most")
        )
        # a small table: at most BUCKETS + 2 rows per interval
        ahead = Window.partitionBy(*group, "lo", "hi").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        offset = F.col("k") - F.col("before")
        state = written(
            still.join(counted, [*group, "lo", "hi"])
            .where((offset >= F.col("ahead")) & (offset < F.col("ahead") + F.col("n")))
            .select(*group, "k", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("before") + F.col("ahead")).alias("before")),
            "ranks",
        )
        first = False


def quantiles(rows: DataFrame, group: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """``(group..., q, quantile)`` with linear interpolation between order statistics."""
    if not group:
        return quantiles(rows.withColumn("__all", F.lit(0)), ["__all"], value, qs).drop("__all")
    group = list(group)
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    h = (F.col("n") - 1) * F.col("q")
    wanted = sizes.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).select(
        *group, "q", h.alias("h"), F.floor(h).alias("k0"), F.ceil(h).alias("k1")
    )
    wanted = written(wanted, "quantiles")
    ranks = wanted.select(*group, F.col("k0").alias("k")).union(wanted.select(*group, "k1")).distinct()
    found = written(order_statistics(rows, group, value, ranks), "order-statistics")
    low = found.withColumnsRenamed({"k": "k0", "v": "v0"})
    high = found.withColumnsRenamed({"k": "k1", "v": "v1"})
    both = wanted.join(low, [*group, "k0"]).join(high, [*group, "k1"])
    return both.select(*group, "q", (F.col("v0") + (F.col("h") - F.col("k0")) * (F.col("v1") - F.col("v0"))).alias("quantile"))
