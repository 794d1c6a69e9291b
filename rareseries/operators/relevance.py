"""Time-delay embedding and imbalance scoring.

The targets of the k-lag embedding are the non-null values after the first
``k`` of each series (``cpos >= k``). Every per-series quantity (quartiles,
adjacent values, outlier flags) is computed as an aggregate, then attached to
the target rows with a join salted by chunk, so a long series never lands on
one reducer.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import imbalance_level, relevance
from ..params import DEFAULT, ScoreParams
from ..plans.joins import CHUNK, broadcast_if_small, chunk_keys, salted_attach
from ..plans.quantiles import exact_quantiles


def targets(comp: DataFrame, k: int = DEFAULT.k, key: str = "id") -> DataFrame:
    """Target column of the embedding: ``(id, _chunk, cpos, y)`` for ``cpos >= k``."""
    return comp.filter(F.col("cpos") >= k).select(key, CHUNK, "cpos", F.col("value").alias("y"))


def embedding(comp: DataFrame, k: int = DEFAULT.k, key: str = "id", chunk_rows: int = DEFAULT.chunk_rows
              ) -> DataFrame:
    """Full embedding rows ``(id, t, lag_k .. lag_1, target)`` for every target t.

    Series with at most ``chunk_rows`` clean points use ``lag`` windows on
    ``id`` (one exchange, no copies). Longer series use the same windows on
    chunks, each with the k points before it as a halo, so no task holds a
    whole series and k points a chunk move twice.
    """
    clean = comp.filter(F.col("cpos").isNotNull()).select(key, "cpos", "value")
    sizes = clean.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot, n_hot = broadcast_if_small(sizes.filter(F.col("_n") > chunk_rows).select(key))
    if n_hot == 0:
        return _embedding_windows(clean, k, key)
    return _embedding_windows(clean.join(hot, key, "left_anti"), k, key).unionByName(
        _embedding_halo(clean.join(hot, key, "left_semi"), k, key, max(chunk_rows, k)))


def _lags(k: int, w) -> list:
    return [F.lag("value", i).over(w).alias(f"lag_{i}") for i in range(k, 0, -1)]


def _embedding_windows(clean: DataFrame, k: int, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy("cpos")
    return clean.select(key, F.col("cpos").alias("t"), *_lags(k, w), F.col("value").alias("target")).filter(
        F.col("t") >= k)


def _embedding_halo(clean: DataFrame, k: int, key: str, chunk_rows: int) -> DataFrame:
    at = F.floor(F.col("cpos") / F.lit(chunk_rows)).cast("long")
    last = F.col("cpos") % F.lit(chunk_rows) >= F.lit(chunk_rows - k)  # the next chunk's halo
    d = clean.withColumn(CHUNK, F.explode(F.when(last, F.array(at, at + 1)).otherwise(F.array(at))))
    w = Window.partitionBy(key, CHUNK).orderBy("cpos")
    d = d.select(key, CHUNK, F.col("cpos").alias("t"), *_lags(k, w), F.col("value").alias("target"))
    return d.filter((F.floor(F.col("t") / F.lit(chunk_rows)) == F.col(CHUNK)) & (F.col("t") >= k)).drop(CHUNK)


def with_fences(q: DataFrame, params: ScoreParams = DEFAULT, key: str = "id") -> DataFrame:
    """Quartiles with the boxplot fences."""
    reach = F.lit(params.rel_coef) * (F.col("q3") - F.col("q1"))
    return q.select(key, "q1", "median", "q3", (F.col("q1") - reach).alias("lower_fence"), (F.col("q3") + reach).alias("upper_fence"))


def adjacent_values(fenced: DataFrame, key: str = "id") -> DataFrame:
    """Of targets with their fences: number, values adjacent to the fences, and whether any lies beyond."""
    y = F.col("y")
    return fenced.groupBy(key).agg(
        F.count(y).alias("N"),
        F.max(F.when(y <= F.col("upper_fence"), y)).alias("hi_adj"),
        F.min(F.when(y >= F.col("lower_fence"), y)).alias("lo_adj"),
        (F.count_if(y > F.col("upper_fence")) > 0).alias("_any_hi"),
        (F.count_if(y < F.col("lower_fence")) > 0).alias("_any_lo"),
    )


def control_rows(fences: DataFrame, flags: DataFrame, params: ScoreParams = DEFAULT, key: str = "id") -> DataFrame:
    hi_ok = params.rel_xtrm_type in ("both", "high")
    lo_ok = params.rel_xtrm_type in ("both", "low")
    return fences.join(flags, key, "inner").select(
        key, "N", "q1", "median", "q3", "lower_fence", "upper_fence", "lo_adj", "hi_adj",
        (F.col("_any_lo") & F.lit(lo_ok)).alias("lo_on"),
        (F.col("_any_hi") & F.lit(hi_ok)).alias("hi_on"))


def control_points(tg: DataFrame, params: ScoreParams = DEFAULT, key: str = "id") -> DataFrame:
    """Quartiles, fences, adjacent values and outlier flags of the targets.

    Output: ``id, N, q1, median, q3, lower_fence, upper_fence, lo_adj, hi_adj,
    lo_on, hi_on``.
    """
    q = exact_quantiles(tg.select(key, "y"), [0.25, 0.5, 0.75], ["q1", "median", "q3"], key=key,
                        val="y", chunk_rows=params.chunk_rows)
    fences = with_fences(q, params, key)
    return control_rows(fences, adjacent_values(salted_attach(tg, fences, chunk_keys(tg, key), key), key), params, key)


def phi_column() -> F.Column:
    return relevance("y", "median", "hi_adj", "lo_adj", "hi_on", "lo_on")


def scored_targets(tg: DataFrame, cp: DataFrame, key: str = "id") -> DataFrame:
    """Every target with its relevance ``phi``."""
    cols = cp.select(key, "median", "hi_adj", "lo_adj", "hi_on", "lo_on")
    return salted_attach(tg, cols, chunk_keys(tg, key), key).withColumn("phi", phi_column())


def rare_counts(scored: DataFrame, params: ScoreParams = DEFAULT, key: str = "id") -> DataFrame:
    """Targets and rare ones of each series, from their relevance ``phi``."""
    return scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("N"),
        F.count_if(F.col("phi") >= F.lit(params.rel_thres)).alias("n_rare"))


def imbalance_scores(tg: DataFrame, params: ScoreParams = DEFAULT, key: str = "id",
                     cp: DataFrame | None = None) -> DataFrame:
    """``id, N, n_normal, n_rare, IR, pct_rare, imbalance_level`` per series with targets."""
    cp = cp if cp is not None else control_points(tg, params, key)
    rare = rare_counts(scored_targets(tg, cp, key), params, key)
    n, r = F.col("N"), F.col("n_rare")
    out = rare.select(
        key, n.alias("N"), (n - r).alias("n_normal"), r.alias("n_rare"),
        F.when(r == 0, F.lit(float("inf"))).otherwise(F.try_divide((n - r).cast("double"), r)).alias("IR"),
        (F.lit(100.0) * F.try_divide(r.cast("double"), n)).alias("pct_rare"))
    return out.withColumn("imbalance_level", imbalance_level("n_rare", "pct_rare"))
