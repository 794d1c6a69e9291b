"""Score a whole panel into scan rows.

Series are split by length once (one small aggregate and a count):

* bounded series (at most ``chunk_rows`` points) take the window form: every
  window is partitioned by ``id``, so compact positions, the lag-1 pairs, the
  quartiles, adjacent values, relevance and the final aggregate share one
  exchange and one sort, and no task holds more than ``chunk_rows`` points of
  one series;
* longer series take the chunked form: points move once into chunks, a record
  of each chunk carries what crosses its borders, and the rest are aggregates
  over the written points; quartiles are exact, between the bounds of a sketch.

The hash is one ordered stream per series. Per-series results are joined to
the header, which keeps series without any point (``skipped_short`` rows).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import imbalance_level, relevance
from ..params import DEFAULT, NOTE_MAX_CHARS, ScoreParams
from ..plans.joins import CHUNK, broadcast_if_small
from ..plans.quantiles import exact_quantiles
from ..schemas import HEADER_FIELDS, SCAN_COLUMNS
from ..session import written
from .hashing import content_hashes, hashes_of_ordered, with_empty_hash
from .profile import base_stats, clean_values, cv, kurtosis_unbiased, lag1_pairs_stats, missing_pct, skewness_unbiased
from .relevance import adjacent_values, control_rows, phi_column, rare_counts, with_fences

STAT_COLUMNS = ["id", "length", "n_obs", "n_missing", "n_infinite", "mean", "std", "_var_pop", "_g1", "_g2",
                "autocorr_lag1", "N", "n_rare"]
_UNB = Window.unboundedPreceding


def _autocorr(cov, sx, sl) -> F.Column:
    r = F.try_divide(cov, sx * sl)
    return F.when((sx > 0) & (sl > 0), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))


def windowed_bounded(pv: DataFrame, params: ScoreParams = DEFAULT) -> DataFrame:
    """Points with compact position, previous value, quartiles, adjacent values and relevance,
    all from windows on ``id`` (one exchange, one sort)."""
    v, y = F.col("value"), F.col("y")
    w_ord = Window.partitionBy("id").orderBy("pos")
    w_all = Window.partitionBy("id")
    d = (pv.withColumn("cpos", F.when(v.isNotNull(), F.count(v).over(w_ord.rowsBetween(_UNB, 0)) - 1))
           .withColumn("prev", F.when(v.isNotNull(), F.last(v, ignorenulls=True).over(w_ord.rowsBetween(_UNB, -1))))
           .withColumn("y", F.when(F.col("cpos") >= params.k, v))
           .withColumn("_q", F.percentile(y, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(w_all)))
    iqr = F.col("_q")[2] - F.col("_q")[0]
    d = (d.withColumn("median", F.col("_q")[1])
          .withColumn("_lf", F.col("_q")[0] - F.lit(params.rel_coef) * iqr)
          .withColumn("_uf", F.col("_q")[2] + F.lit(params.rel_coef) * iqr))
    hi_ok = params.rel_xtrm_type in ("both", "high")
    lo_ok = params.rel_xtrm_type in ("both", "low")
    d = (d.withColumn("hi_adj", F.max(F.when(y <= F.col("_uf"), y)).over(w_all))
          .withColumn("lo_adj", F.min(F.when(y >= F.col("_lf"), y)).over(w_all))
          .withColumn("hi_on", (F.count_if(y > F.col("_uf")).over(w_all) > 0) & F.lit(hi_ok))
          .withColumn("lo_on", (F.count_if(y < F.col("_lf")).over(w_all) > 0) & F.lit(lo_ok)))
    return d.withColumn("phi", F.when(y.isNotNull(), relevance("y", "median", "hi_adj", "lo_adj", "hi_on",
                                                                 "lo_on")))


def stats_bounded(pv: DataFrame, params: ScoreParams = DEFAULT, d: DataFrame | None = None) -> DataFrame:
    """All per-series statistics of bounded series (aggregate of :func:`windowed_bounded`)."""
    d = d if d is not None else windowed_bounded(pv, params)
    v, y, phi = F.col("value"), F.col("y"), F.col("phi")
    finite = v.isNull() | ((v != F.lit(float("inf"))) & (v != F.lit(float("-inf"))))
    paired = F.when(F.col("prev").isNotNull(), v)
    agg = d.groupBy("id").agg(
        F.count(F.lit(1)).alias("length"), F.count(v).alias("n_obs"),
        F.count_if(v.isNull()).alias("n_missing"), F.count_if(~finite).alias("n_infinite"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.var_pop(v).alias("_var_pop"),
        F.skewness(v).alias("_g1"), F.kurtosis(v).alias("_g2"),
        F.covar_pop(paired, F.col("prev")).alias("_cov"), F.stddev_pop(paired).alias("_sx"),
        F.stddev_pop("prev").alias("_sl"),
        F.count(y).alias("N"), F.count_if(phi >= F.lit(params.rel_thres)).alias("n_rare"))
    return agg.withColumn("autocorr_lag1", _autocorr(F.col("_cov"), F.col("_sx"), F.col("_sl"))) \
              .select(*STAT_COLUMNS)


def segments(pv: DataFrame, chunk_rows: int) -> DataFrame:
    """Points of long series by chunk of ``chunk_rows`` positions, written once: ``id, _chunk, pos, value``, the
    number ``_nth`` of values in the chunk so far and the value before, ``prev``, in the same chunk."""
    v = F.col("value")
    w = Window.partitionBy("id", CHUNK).orderBy("pos")
    p = pv.withColumn(CHUNK, F.floor(F.col("pos") / F.lit(chunk_rows)).cast("long"))
    return written(p.select("id", CHUNK, "pos", "value", F.count(v).over(w.rowsBetween(_UNB, 0)).alias("_nth"),
                            F.last(v, ignorenulls=True).over(w.rowsBetween(_UNB, -1)).alias("prev")))


def chunk_records(seg: DataFrame) -> DataFrame:
    """One record a chunk, folded over the chunks before: its first value, the values before it (``_before``) and the last of them (``_left``)."""
    there = F.when(F.col("value").isNotNull(), F.col("pos"))
    records = seg.groupBy("id", CHUNK).agg(F.count("value").alias("_n"), F.min_by("value", there).alias("_first"), F.max_by("value", there).alias("_last"))
    past = Window.partitionBy("id").orderBy(CHUNK).rowsBetween(_UNB, -1)
    return records.select("id", CHUNK, "_first", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_before"),
                          F.last("_last", ignorenulls=True).over(past).alias("_left"))


def stats_chunked(pv: DataFrame, params: ScoreParams = DEFAULT) -> DataFrame:
    """The same statistics for series longer than ``chunk_rows`` (no window on a whole series).

    Points move once, into their chunks. What crosses chunk borders (the pair of a chunk's first value with the one before it, the
    first ``k`` values of a series) comes from the chunks' records; all else are aggregates over the written points, to which
    per-series numbers are joined (a broadcast while there are few long series, else by hash and split where skewed).
    """
    seg = segments(pv, params.chunk_rows)
    records = written(chunk_records(seg))
    base = written(base_stats(seg))
    v, y = F.col("value"), F.col("y")
    borders = records.filter(F.col("_first").isNotNull() & F.col("_left").isNotNull()).select("id", F.col("_first").alias("value"), F.col("_left").alias("prev"))
    autocorr = lag1_pairs_stats(seg.select("id", "value", "prev").unionByName(borders))

    # A series with an infinite value is reported as an error and has no quantiles.
    finite, _ = broadcast_if_small(base.filter("n_infinite = 0").select("id"))
    heads, _ = broadcast_if_small(records.filter(F.col("_before") < params.k).select("id", CHUNK, "_before"))
    tg = seg.filter(v.isNotNull()).join(finite, "id", "left_semi").join(heads, ["id", CHUNK], "left")
    tg = tg.filter(F.col("_before").isNull() | (F.col("_before") + F.col("_nth") > params.k)).select("id", v.alias("y"))
    q = exact_quantiles(tg, [0.25, 0.5, 0.75], ["q1", "median", "q3"], all_hot=True, stored=True)
    fences, _ = broadcast_if_small(written(with_fences(q, params)))
    flags = adjacent_values(tg.join(fences, "id"))
    points, _ = broadcast_if_small(written(control_rows(fences, flags, params)))
    scores = rare_counts(tg.join(points, "id").withColumn("phi", phi_column()), params)
    return base.join(autocorr, "id", "left").join(scores, "id", "left").select(*STAT_COLUMNS)


def _bounded_parts(pv: DataFrame, params: ScoreParams, with_hash: bool):
    d = windowed_bounded(pv, params)
    stats = stats_bounded(pv, params, d)
    # The hash streams over the same window output (clustered by id, sorted by
    # pos), so it shares the window's shuffle; ``cpos`` keeps that window alive.
    ordered = d.filter(F.col("value").isNotNull()).select("id", "pos", "value", "cpos")
    hashes = hashes_of_ordered(ordered) if with_hash else None
    return stats, hashes


def series_stats(pv: DataFrame, params: ScoreParams = DEFAULT, with_hash: bool = False):
    """Per-series statistics (and hashes), routing each series by its length.

    Returns ``(stats, hashes)``; ``hashes`` is None without ``with_hash``.
    """
    lengths = pv.groupBy("id").agg(F.count(F.lit(1)).alias("_len"))
    hot_ids, n_hot = broadcast_if_small(lengths.filter(F.col("_len") > params.chunk_rows).select("id"))
    if n_hot == 0:
        return _bounded_parts(pv, params, with_hash)
    stats, hashes = _bounded_parts(pv.join(hot_ids, "id", "left_anti"), params, with_hash)
    hot_pv = pv.join(hot_ids, "id", "left_semi")
    stats = stats.unionByName(stats_chunked(hot_pv, params))
    if with_hash:
        hashes = hashes.unionByName(content_hashes(hot_pv))
    return stats, hashes


def status_column(n, n_infinite, params: ScoreParams = DEFAULT) -> F.Column:
    return (F.when(n < params.min_points, F.lit("skipped_short"))
             .when(n_infinite > 0, F.lit("error"))
             .otherwise(F.lit("ok")))


def note_column(n, n_infinite, params: ScoreParams = DEFAULT) -> F.Column:
    short = F.concat(F.lit("only "), n.cast("string"), F.lit(" non-null values, need >= "),
                     F.lit(str(params.min_points)), F.lit(" to embed"))
    note = (F.when(n < params.min_points, short)
             .when(n_infinite > 0, F.lit("series holds infinite values; relevance undefined")))
    return F.substring(note, 1, NOTE_MAX_CHARS)


def score_panel(header: DataFrame, panel: DataFrame, params: ScoreParams = DEFAULT,
                with_hash: bool = True) -> DataFrame:
    """24-column scan rows (``pct_rare`` for ``%Rare``), one per header row."""
    pv = clean_values(panel.select("id", "pos", "value"))
    stats, hashes = series_stats(pv, params, with_hash)
    rows = header.select(*HEADER_FIELDS).join(stats, "id", "left")
    if with_hash:
        rows = rows.join(hashes, "id", "left")
    else:
        rows = rows.withColumn("content_hash", F.lit(None).cast("string"))

    n = F.coalesce(F.col("n_obs"), F.lit(0))
    n_inf = F.coalesce(F.col("n_infinite"), F.lit(0))
    status = status_column(n, n_inf, params)
    ok = status == "ok"
    has_moments = (status != "skipped_short") & (n_inf == 0)
    big_n, rare = F.col("N"), F.col("n_rare")
    pct = F.lit(100.0) * F.try_divide(rare.cast("double"), big_n)
    out = rows.select(
        *HEADER_FIELDS,
        F.coalesce(F.col("length"), F.lit(0)).cast("long").alias("length"),
        with_empty_hash().alias("content_hash") if with_hash else F.col("content_hash"),
        F.when(ok, big_n).alias("N"),
        F.when(ok, big_n - rare).alias("n_normal"),
        F.when(ok, rare).alias("n_rare"),
        F.when(ok, F.when(rare == 0, F.lit(float("inf")))
               .otherwise(F.try_divide((big_n - rare).cast("double"), rare))).alias("IR"),
        F.when(ok, pct).alias("pct_rare"),
        F.when(ok, imbalance_level(rare, pct)).alias("imbalance_level"),
        missing_pct().alias("missing_pct"),
        F.when(has_moments, F.col("mean")).alias("mean"),
        F.when(has_moments, F.col("std")).alias("std"),
        F.when(has_moments, cv()).alias("cv"),
        F.when(has_moments, skewness_unbiased()).alias("skewness"),
        F.when(has_moments, kurtosis_unbiased()).alias("kurtosis"),
        F.when(has_moments, F.col("autocorr_lag1")).alias("autocorr_lag1"),
        status.alias("status"),
        note_column(n, n_inf, params).alias("note"),
    )
    return out.select(*SCAN_COLUMNS)


def level_counts(scan: DataFrame) -> DataFrame:
    """Number of series per imbalance level (scored series only)."""
    return (scan.filter(F.col("status") == "ok").groupBy("imbalance_level")
            .agg(F.count(F.lit(1)).alias("n_series")))
