"""Data-quality profile: missingness, label frequencies, shape, diagnostics.

Each profile is one aggregation pass over the table (never a job per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """Missing percentage per column, highest first (ties by column name).

    One pass computes every column's share, then ``unpivot`` turns the single
    row into (column, missing_pct) rows. ``top`` keeps the first rows (a report).
    """
    cols = list(columns or df.columns)
    wide = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100.0).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "missing_pct")
    out = long.orderBy(F.desc("missing_pct"), F.asc("column"))
    return out.limit(top) if top is not None else out


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint")
    )


def label_counts(df: DataFrame, label: str, include_missing: bool = False) -> DataFrame:
    """Frequency per label value, sorted by label (missing last when included)."""
    src = df if include_missing else df.where(F.col(label).isNotNull())
    return (
        src.groupBy(label)
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        .orderBy(F.asc_nulls_last(label))
    )


def feature_diagnostics(df: DataFrame, column: str, approx_distinct: bool = False) -> DataFrame:
    """Bias-corrected sample skewness, distinct non-NULL values, missing count.

    Spark's ``skewness`` is the population moment ratio g1; the adjusted
    Fisher-Pearson coefficient is ``g1 * sqrt(n(n-1)) / (n-2)`` over the n
    non-NULL values. ``approx_distinct`` swaps the exact distinct count for a
    HyperLogLog++ sketch (bounded memory at any scale).
    """
    c = F.col(column)
    n = F.count(c)
    distinct = F.approx_count_distinct(c) if approx_distinct else F.countDistinct(c)
    return df.agg(
        (F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        distinct.cast("bigint").alias("unique_values"),
        F.sum(c.isNull().cast("bigint")).cast("bigint").alias("missing_values"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows (a preview; not ordered)."""
    return df.limit(n)
