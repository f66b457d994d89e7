"""Two-sample statistics, simple regression and permutation summaries.

All statistics are computed from distributed aggregates; only the final
p-value transform (a CDF of an already aggregated statistic, one row) runs in a
vectorised pandas UDF, since Spark SQL has no normal/Student-t CDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from staysift.operators.ranking import hash_key, rows_before


# --- p-value helpers (vectorised, applied to aggregated rows only) -------------


def _betainc_cf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betainc_cf(a, b, x) / a
    return 1.0 - front * _betainc_cf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    if t is None or dof is None or not np.isfinite(t) or dof <= 0:
        return float("nan")
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def normal_two_sided_p(z: float) -> float:
    if z is None or not np.isfinite(z):
        return float("nan")
    return min(1.0, math.erfc(abs(z) / math.sqrt(2.0)))


@F.pandas_udf(DoubleType())
def normal_p_udf(z: pd.Series) -> pd.Series:
    return z.map(lambda v: normal_two_sided_p(v) if pd.notna(v) else np.nan)


@F.pandas_udf(DoubleType())
def t_p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else np.nan for a, b in zip(t, dof)]
    )


# --- two-sample comparisons ----------------------------------------------------


def cohens_d(df: DataFrame, value: str, is_high: Column) -> DataFrame:
    """Cohen's d (high minus low) with the pooled sample variance; one pass."""
    v = F.col(value)
    hi = F.when(is_high & v.isNotNull(), v)
    lo = F.when(~is_high & v.isNotNull(), v)
    agg = df.agg(
        F.count(hi).alias("n_high"),
        F.count(lo).alias("n_low"),
        F.avg(hi).alias("mean_high"),
        F.avg(lo).alias("mean_low"),
        F.var_samp(hi).alias("var_high"),
        F.var_samp(lo).alias("var_low"),
    )
    pooled = F.sqrt(
        ((F.col("n_high") - 1) * F.col("var_high") + (F.col("n_low") - 1) * F.col("var_low"))
        / (F.col("n_high") + F.col("n_low") - 2)
    )
    return agg.withColumn("cohens_d", (F.col("mean_high") - F.col("mean_low")) / pooled)


EXACT_SMALLER = 8  # rows of the smaller sample up to which "auto" is exact
EXACT_CELLS = 20_000_000  # and products of the sample sizes


def exact_u_p(u: float, n1: int, n2: int) -> float:
    """Two-sided p of the Mann-Whitney U statistic without ties, from the number of orders
    of the two samples for each value of U: the coefficients of a Gaussian binomial, of which the
    tail up to the smaller U is counted. Shares of all orders stand for counts, so any sizes do."""
    small, large = min(n1, n2), max(n1, n2)
    if small < 1:
        return float("nan")
    tail = int(math.floor(min(u, n1 * n2 - u) + 1e-9))
    ways = np.zeros(tail + 1)
    ways[0] = 1.0
    for i in range(1, small + 1):
        # one more row in the smaller sample: times (1 - q^(large + i)) / (1 - q^i)
        if large + i <= tail:
            ways[large + i :] = ways[large + i :] - ways[: tail + 1 - large - i].copy()
        padded = np.zeros(-(-(tail + 1) // i) * i)
        padded[: tail + 1] = ways
        ways = np.cumsum(padded.reshape(-1, i), axis=0).ravel()[: tail + 1] * (i / (large + i))
    return float(min(1.0, 2.0 * ways.sum()))


@F.pandas_udf(DoubleType())
def exact_u_p_udf(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([exact_u_p(a, int(b), int(c)) if pd.notna(a) else np.nan for a, b, c in zip(u, n1, n2, strict=True)])


def mann_whitney(df: DataFrame, value: str, is_high: Column, continuity: bool = True, method: str = "auto") -> DataFrame:
    """Two-sided Mann-Whitney U: by the normal approximation with tie correction
    (``method="asymptotic"``) or by the exact distribution of U (``"exact"``, which holds without
    ties). ``"auto"`` is exact where no value occurs twice, the smaller sample has at most
    ``EXACT_SMALLER`` rows and the sample sizes multiply to at most ``EXACT_CELLS``. Either way one
    aggregated row is all that the p-value is computed from; ``exact`` says which it was.

    Ranks are computed on the table of distinct values (counts per sample), with
    mid-ranks for ties: rank(v) = rows_before(v) + (count(v) + 1) / 2.
    ``u_statistic`` is U for the high sample; ``z`` uses max(U1, U2) as the
    two-sided test does; ``p_value`` = 2 * sf(z).
    """
    v = F.col(value)
    counts = (
        df.where(v.isNotNull() & is_high.isNotNull())
        .groupBy(v.cast("double").alias("__v"))
        .agg(
            F.sum(is_high.cast("bigint")).alias("__nh"),
            F.sum((~is_high).cast("bigint")).alias("__nl"),
        )
        .withColumn("__c", F.col("__nh") + F.col("__nl"))
    )
    ranked = rows_before(counts, ["__v"], (), "__c", out_col="__before")
    mid = F.col("__before") + (F.col("__c") + 1) / 2.0
    agg = ranked.agg(
        F.sum("__nh").cast("double").alias("n1"),
        F.sum("__nl").cast("double").alias("n2"),
        F.sum(F.col("__nh") * mid).alias("r1"),
        F.sum(F.pow(F.col("__c").cast("double"), 3) - F.col("__c")).alias("tie"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    u_max = F.greatest(u1, n1 * n2 - u1)
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1))))
    z = F.try_divide(u_max - n1 * n2 / 2.0 - (0.5 if continuity else 0.0), sigma)  # NULL without spread
    if method not in ("auto", "exact", "asymptotic"):
        raise ValueError("method must be 'auto', 'exact' or 'asymptotic'")
    fits = (F.col("tie") == 0) & (F.least(n1, n2) <= EXACT_SMALLER) & (n1 * n2 <= EXACT_CELLS)
    exact = {"auto": F.coalesce(fits, F.lit(False)), "exact": F.lit(True), "asymptotic": F.lit(False)}[method]
    out = agg.select(
        n1.cast("bigint").alias("n_high"),
        n2.cast("bigint").alias("n_low"),
        u1.alias("u_statistic"),
        z.alias("z"),
        exact.alias("exact"),
    )
    if method == "asymptotic":
        p = normal_p_udf("z")
    else:  # only where it applies is the distribution counted
        counted = exact_u_p_udf(F.when(F.col("exact"), F.col("u_statistic")), "n_high", "n_low")
        p = F.when(F.col("exact"), counted).otherwise(normal_p_udf("z"))
    return out.withColumn("p_value", p).withColumn("test", F.lit("Mann-Whitney U"))


def ols_simple(df: DataFrame, x: str, y: str) -> DataFrame:
    """OLS of y on x with intercept over rows where both are present:
    n, coefficient (slope), intercept, r_squared, t and two-sided p."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    agg = df.agg(
        F.regr_count(ys, xs).cast("bigint").alias("n"),
        F.regr_slope(ys, xs).alias("coefficient"),
        F.regr_intercept(ys, xs).alias("intercept"),
        F.regr_r2(ys, xs).alias("r_squared"),
        F.regr_sxx(ys, xs).alias("sxx"),
        F.regr_syy(ys, xs).alias("syy"),
    )
    sse = (1 - F.col("r_squared")) * F.col("syy")
    se = F.sqrt(sse / (F.col("n") - 2) / F.col("sxx"))
    out = agg.withColumn("t", F.col("coefficient") / se)
    return (
        out.withColumn("p_value", t_p_udf("t", (F.col("n") - 2).cast("double")))
        .withColumn("test", F.lit("OLS regression"))
        .drop("sxx", "syy")
    )


# --- bootstrap band -------------------------------------------------------------


BOOT_PRIME = 2_147_483_647  # 2^31 - 1


def _poisson1_from_uniform(u: Column, grid: int = BOOT_PRIME) -> Column:
    """Inverse CDF of Poisson(1) on a uniform grid in [0, 1). Thresholds end where the
    remaining tail is below one step of the grid: no draw can lie beyond."""
    kmax, rest, term = 0, 1.0 - math.exp(-1.0), math.exp(-1.0)
    while rest * grid >= 1.0:
        kmax += 1
        term /= kmax
        rest -= term
    cdf = 0.0
    term = math.exp(-1.0)
    expr = None
    for k in range(kmax + 1):
        cdf += term
        term /= k + 1
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(kmax + 1))


def regression_band(
    df: DataFrame,
    x: str,
    y: str,
    id_cols: list[str],
    n_boot: int = 1000,
    grid: int = 100,
    seed: int = 42,
    level: float = 0.95,
) -> DataFrame:
    """Regression line with a bootstrap confidence band, as a table.

    Poisson bootstrap: every row gets a Poisson(1) weight per replicate from a
    seeded hash of its id (pairwise independent across replicates), so no
    resample is materialised. Each task explodes its rows over the replicates and folds
    them straight into a partial aggregate (five weighted sums per replicate), so
    only ``n_boot`` small rows per task cross the shuffle. Output: one row per
    grid x with the fit and the band. Defaults follow the usual regression-plot
    band: 1000 replicates, 100 grid points, 95 %.
    """
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    base = df.where(xs.isNotNull() & ys.isNotNull()).select(*id_cols, xs.alias("__x"), ys.alias("__y"))
    # one md5 per row gives (a, b); replicate r draws u = ((a + b*r) mod p) / p,
    # a pairwise-independent family, so the exploded rows need no hashing
    h = hash_key(id_cols, seed)
    keyed = base.withColumn("__a", F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % F.lit(BOOT_PRIME)).withColumn(
        "__bb", F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint") % F.lit(BOOT_PRIME - 1) + 1
    )
    # replicate -1 carries weight 1 everywhere: the fit on the full data
    reps = keyed.select("*", F.explode(F.sequence(F.lit(-1), F.lit(n_boot - 1))).alias("rep"))
    u = ((F.col("__a") + F.col("__bb") * F.col("rep")) % F.lit(BOOT_PRIME)) / F.lit(float(BOOT_PRIME))
    w = F.when(F.col("rep") < 0, F.lit(1.0)).otherwise(_poisson1_from_uniform(u).cast("double"))
    sums = reps.withColumn("__w", w).groupBy("rep").agg(
        F.sum("__w").alias("sw"),
        F.sum(F.col("__w") * F.col("__x")).alias("sx"),
        F.sum(F.col("__w") * F.col("__y")).alias("sy"),
        F.sum(F.col("__w") * F.col("__x") * F.col("__x")).alias("sxx"),
        F.sum(F.col("__w") * F.col("__x") * F.col("__y")).alias("sxy"),
        F.min("__x").alias("lo"),
        F.max("__x").alias("hi"),
    )
    slope = (F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy")) / (
        F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx")
    )
    fits = sums.select(
        "rep", "lo", "hi", slope.alias("b1"), ((F.col("sy") - slope * F.col("sx")) / F.col("sw")).alias("b0")
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(max(grid - 1, 1)))
    preds = fits.select(
        "rep", "b0", "b1", "lo", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g")
    ).withColumn("x", F.col("lo") + F.col("step") * F.col("g"))
    preds = preds.withColumn("pred", F.col("b0") + F.col("b1") * F.col("x"))
    alpha = (1 - level) / 2
    boot = F.when(F.col("rep") >= 0, F.col("pred"))
    band = preds.groupBy("g").agg(
        F.max("x").alias("x"),
        F.max(F.when(F.col("rep") < 0, F.col("pred"))).alias("fit"),
        F.percentile(boot, [alpha, 1 - alpha]).alias("q"),
    )
    return band.select(
        F.col("g").cast("bigint").alias("g"), "x", "fit", F.col("q")[0].alias("band_low"), F.col("q")[1].alias("band_high")
    )


# --- permutation summaries ------------------------------------------------------


def null_summary(null_values: DataFrame, observed: DataFrame, key: str, value: str) -> DataFrame:
    """Per ``key``: mean and sample sd of the null distribution and the empirical
    two-sided p = (#{|null| >= |observed|} + 1) / (n + 1)."""
    j = null_values.join(observed.select(key, F.col(value).alias("__obs")), key, "inner")
    extreme = (F.abs(F.col(value)) >= F.abs(F.col("__obs"))).cast("bigint")
    return j.groupBy(key).agg(
        F.first("__obs").alias("observed_coefficient"),
        ((F.sum(extreme) + 1) / (F.count(F.lit(1)) + 1)).alias("empirical_p_value_two_sided"),
        F.avg(value).alias("null_mean"),
        F.stddev_samp(value).alias("null_std"),
        F.count(F.lit(1)).cast("bigint").alias("n_permutations"),
    )
