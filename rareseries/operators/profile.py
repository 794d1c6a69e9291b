"""Per-series profile.

All moments are mergeable aggregates, so Spark combines them map-side and a
huge series costs no more than its share of the scan. Only the lag-1 pairs
need order; they come from :func:`rareseries.plans.sequence.compact`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT

# pandas treats a sum of squared deviations below this as zero (skew/kurt -> 0).
FP_ZERO = 1e-14


def clean_values(df: DataFrame, col: str = "value") -> DataFrame:
    """NaN -> NULL at the source boundary (NaN compares greater than any number in Spark)."""
    c = F.col(col)
    return df.withColumn(col, F.when(~F.isnan(c), c).cast("double"))


def base_stats(panel: DataFrame, key: str = "id") -> DataFrame:
    """length, non-null count, missing count and raw moments of every series."""
    v = F.col("value")
    finite = v.isNull() | ((v != F.lit(float("inf"))) & (v != F.lit(float("-inf"))))
    return panel.groupBy(key).agg(
        F.count(F.lit(1)).alias("length"),
        F.count(v).alias("n_obs"),
        F.count_if(v.isNull()).alias("n_missing"),
        F.count_if(~finite).alias("n_infinite"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.var_pop(v).alias("_var_pop"),
        F.skewness(v).alias("_g1"),
        F.kurtosis(v).alias("_g2"),
    )


def missing_pct(length="length", n_missing="n_missing") -> F.Column:
    """round(100 * missing / length, 4); NULL for an empty series."""
    return F.round(F.lit(100.0) * F.try_divide(F.col(n_missing).cast("double"), F.col(length)), 4)


def cv(mean="mean", std="std") -> F.Column:
    m = F.col(mean)
    return F.when(F.abs(m) > F.lit(1e-12), F.try_divide(F.col(std), F.abs(m)))


def skewness_unbiased(n="n_obs", var_pop="_var_pop", g1="_g1") -> F.Column:
    """Bias-corrected G1 from Spark's population g1; 0 for a (near) constant series."""
    n_, m2 = F.col(n).cast("double"), F.col(var_pop) * F.col(n)
    adj = F.sqrt(n_ * (n_ - 1)) / (n_ - 2)
    return F.when(n_ < 3, F.lit(None)).when(m2 < F.lit(FP_ZERO), F.lit(0.0)).otherwise(F.col(g1) * adj)


def kurtosis_unbiased(n="n_obs", var_pop="_var_pop", g2="_g2") -> F.Column:
    """Bias-corrected excess G2 from Spark's population g2; 0 for a (near) constant series."""
    n_, m2 = F.col(n).cast("double"), F.col(var_pop) * F.col(n)
    denom = (n_ - 2) * (n_ - 3) * m2 * m2
    g = (n_ - 1) / ((n_ - 2) * (n_ - 3)) * ((n_ + 1) * F.col(g2) + 6)
    return F.when(n_ < 4, F.lit(None)).when(denom < F.lit(FP_ZERO), F.lit(0.0)).otherwise(g)


def lag1_pairs_stats(comp: DataFrame, key: str = "id") -> DataFrame:
    """Pearson correlation of consecutive non-null values (x_t, x_{t-1}).

    Built from mergeable covariance/deviation aggregates; NULL when either
    side is constant (no division error under ANSI mode).
    """
    pairs = comp.filter(F.col("value").isNotNull() & F.col("prev").isNotNull())
    agg = pairs.groupBy(key).agg(
        F.covar_pop("value", "prev").alias("_cov"),
        F.stddev_pop("value").alias("_sx"),
        F.stddev_pop("prev").alias("_sl"),
    )
    r = F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sl"))
    r = F.when((F.col("_sx") > 0) & (F.col("_sl") > 0), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))
    return agg.select(key, r.alias("autocorr_lag1"))


def profile_moments(panel: DataFrame, key: str = "id") -> DataFrame:
    """P1-P3, P7-P10 for every series that has at least one point."""
    b = base_stats(panel, key)
    return b.select(
        key, "length", F.col("n_obs"), missing_pct().alias("missing_pct"), "mean", "std", cv().alias("cv"),
        skewness_unbiased().alias("skewness"), kurtosis_unbiased().alias("kurtosis"))


def autocorr(panel: DataFrame, chunk_rows: int = DEFAULT.chunk_rows, key: str = "id") -> DataFrame:
    from ..plans.sequence import compact
    return lag1_pairs_stats(compact(panel.select(key, "pos", "value"), chunk_rows, key), key)
