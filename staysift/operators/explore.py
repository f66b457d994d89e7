"""Exploratory result tables: group means, top/bottom groups, correlations,
box summaries.

Group aggregates are ``groupBy().agg()`` (partial aggregation before the
shuffle, so a hot group costs one row per map task). NULL group keys are
dropped first, as a pandas ``groupby`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staysift.operators.lookup import checked_broadcast
from staysift.operators.selection import quantiles
from staysift.session import written


def _not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def group_mean(df: DataFrame, key: str, value: str, out_col: str = "mean") -> DataFrame:
    """Mean of ``value`` per ``key`` (NULL keys dropped), highest mean first."""
    return (
        _not_null(df, [key])
        .groupBy(key)
        .agg(F.avg(value).alias(out_col))
        .orderBy(F.desc_nulls_last(out_col), F.asc(key))
    )


def group_mean_count(df: DataFrame, keys: Sequence[str], value: str, min_count: int | None = None) -> DataFrame:
    """Mean and non-NULL count of ``value`` per key tuple; groups without any
    value (mean NULL) are dropped; ``min_count`` keeps well-supported groups."""
    out = (
        _not_null(df, keys)
        .groupBy(*keys)
        .agg(F.avg(value).alias("mean"), F.count(value).cast("bigint").alias("count"))
        .where(F.col("mean").isNotNull())
    )
    if min_count is not None:
        out = out.where(F.col("count") >= min_count)
    return out


def group_means(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Several means per key tuple; groups with any NULL mean are dropped."""
    out = _not_null(df, keys).groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])
    return out.dropna(subset=list(values))


def means_by_label(
    df: DataFrame,
    label: str,
    measures: Sequence[str],
    abs_measures: Sequence[str] = (),
) -> DataFrame:
    """One pass: mean of each measure (and mean of |measure|) per label value."""
    aggs = [F.avg(m).alias(f"mean_{m}") for m in measures]
    aggs += [F.avg(F.abs(F.col(m))).alias(f"mean_abs_{m}") for m in abs_measures]
    return _not_null(df, [label]).groupBy(label).agg(*aggs).orderBy(label)


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Top (or bottom) ``k`` rows by ``by``; ties broken by ``tie_breakers``.

    Planned as TakeOrderedAndProject: each task keeps its own best ``k``."""
    order = F.asc(by) if ascending else F.desc(by)
    return df.orderBy(order, *[F.asc(t) for t in tie_breakers]).limit(k)


CORR_PAIRS = 12  # pairs per aggregate: 6 buffer fields each, under the limit of 100


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, pairwise-complete (a pair uses
    the rows where both are non-NULL). Pairs are aggregated a dozen at a time: a wider
    aggregate would pass the field limit of whole-stage code generation.

    Returned long: (col_a, col_b, corr) for all ordered pairs, diagonal = 1 when
    the column has variance."""
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    out = None
    for start in range(0, len(pairs), CORR_PAIRS):
        part = pairs[start : start + CORR_PAIRS]
        wide = df.agg(*[F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(part)])
        rows = [
            F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"c{k}").alias("corr"))
            for k, (a, b) in enumerate(part)
            for x, y in dict.fromkeys([(a, b), (b, a)])
        ]
        long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        out = long if out is None else out.unionByName(long)
    return out


def _measured(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``(group..., __v)`` without NULLs and NaN, written once: the later passes scan it."""
    rows = _not_null(df.select(*group, F.col(value).cast("double").alias("__v")), [*group, "__v"])
    return written(rows.where(~F.isnan("__v")), "measured")


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default) per group, by histogram
    narrowing (``operators.selection``): no sort and no shuffle of values. NULL and NaN
    values are missing. Returns (group..., q, quantile).
    """
    return quantiles(_measured(df, group, value), group, "__v", qs)


def box_summary(df: DataFrame, group: str, value: str, whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: q1, median, q3, whiskers (most extreme values
    within ``whisker`` IQRs of the box), outlier count, n."""
    rows = _measured(df, [group], value)
    qs = quantiles(rows, [group], "__v", [0.25, 0.5, 0.75])
    wide = qs.groupBy(group).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("quantile"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("quantile"))).alias("q3"),
    )
    # one row per group, broadcast after a count; the measured side is never the build side
    j = rows.withColumnRenamed("__v", "__val").join(checked_broadcast(written(wide, "box-quartiles")), group, "inner")
    iqr = F.col("q3") - F.col("q1")
    lo_fence = F.col("q1") - F.lit(whisker) * iqr
    hi_fence = F.col("q3") + F.lit(whisker) * iqr
    inside = (F.col("__val") >= lo_fence) & (F.col("__val") <= hi_fence)
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("__val"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__val"))).alias("whisker_high"),
        F.count(F.when(~inside, 1)).cast("bigint").alias("outliers"),
        F.count(F.lit(1)).cast("bigint").alias("n"),
    )
