"""Exact per-series quantiles that stay bounded when a series is huge.

Quantiles use linear interpolation between order statistics (the rule of
Spark's ``percentile``, DuckDB's ``quantile_cont`` and numpy's default).

* Series with at most ``chunk_rows`` values: Spark's exact ``percentile``
  aggregate. Its buffer holds one series, which is bounded by ``chunk_rows``.
* Longer series ("hot"): a mergeable KLL sketch of each series brackets the
  needed order statistics between two values. One counting pass makes the
  brackets exact (a rank outside of its bracket is known to lie below or above
  it, which widens the bracket to the series' end), and one leaf pass ranks the
  distinct values inside the brackets. The number of passes does not depend
  on how the values are spread.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULT
from ..session import written
from .joins import broadcast_if_small

#: Size parameter of the sketches, and the rank error that the brackets allow for (several times what such a sketch has).
SKETCH_K, MARGIN = 4096, 0.002


def exact_quantiles(values: DataFrame, probs: list[float], names: list[str], key: str = "id",
                    val: str = "y", chunk_rows: int = DEFAULT.chunk_rows, all_hot: bool = False, stored: bool = False) -> DataFrame:
    """One row per key with a column per probability (``names``).

    ``all_hot`` skips the size split when the caller already knows every key is long (the chunked scoring path); ``stored``
    says that the values come from a written table, which the passes may read again.
    """
    values = values.select(key, val).filter(F.col(val).isNotNull())
    if all_hot:
        return _bracketed(values if stored else written(values), probs, names, key, val)
    sizes = values.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot, small = broadcast_if_small(sizes.filter(F.col("_n") > chunk_rows).select(key))
    arr = F.percentile(F.col(val), F.array(*[F.lit(float(p)) for p in probs]))

    def cold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(arr.alias("_q")).select(key, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

    if small == 0:
        return cold(values)
    return cold(values.join(hot, key, "left_anti")).unionByName(
        _bracketed(written(values.join(hot, key, "left_semi")), probs, names, key, val))


def _ranks(probs: list[float], n: Column) -> list[Column]:
    """The two order statistics that each quantile lies between."""
    at = [(n - 1) * F.lit(float(p)) for p in probs]
    return [f(h).cast("long") for h in at for f in (F.floor, F.ceil)]


def _bracketed(values: DataFrame, probs: list[float], names: list[str], key: str, val: str) -> DataFrame:
    y, n = F.col(val), F.col("_n")
    drawn = values.groupBy(key).agg(F.kll_sketch_agg_double(val, F.lit(SKETCH_K)).alias("_s"), F.count(F.lit(1)).alias("_n"),
                                    F.min(val).alias("_min"), F.max(val).alias("_max"))
    ranks = _ranks(probs, n)

    def bound(side: int) -> Column:
        """The sketch's value at each rank's share, a margin below or above it (shares must be constants)."""
        shares = F.array(*[F.lit(min(1.0, max(0.0, p + side * MARGIN))) for p in probs for _ in range(2)])
        return F.kll_sketch_get_quantile_double("_s", shares)

    brackets = drawn.select(key, "_n", "_min", "_max", F.array(*ranks).alias("_r"), bound(-1).alias("_lo"), bound(1).alias("_hi"))
    brackets = written(brackets)
    sides, _ = broadcast_if_small(brackets.select(key, "_lo", "_hi"))
    k = len(ranks)
    counted = values.join(sides, key).groupBy(key).agg(
        F.array(*[F.count_if(y < F.col("_lo")[i]) for i in range(k)]).alias("_below"),
        F.array(*[F.count_if(y <= F.col("_hi")[i]) for i in range(k)]).alias("_to"))
    exact = brackets.join(counted, key).select(key, "_n", F.explode(F.transform(F.arrays_zip("_r", "_lo", "_hi", "_below", "_to"), lambda b: F.struct(
        b["_r"].alias("r"),
        F.when(b["_r"] < b["_below"], F.col("_min")).otherwise(b["_lo"]).alias("lo"),
        F.when(b["_r"] >= b["_to"], F.col("_max")).otherwise(b["_hi"]).alias("hi"),
        F.when(b["_r"] < b["_below"], F.lit(0).cast("long")).otherwise(b["_below"]).alias("before")))).alias("b"))
    exact = written(exact.select(key, "_n", "b.*").distinct())
    # the distinct values of a bracket, counted before they move, are ranked by a prefix sum
    inside, _ = broadcast_if_small(exact.filter("lo < hi").select(key, "lo", "hi", "before").distinct())
    leaf = values.join(inside, (values[key] == inside[key]) & y.between(inside["lo"], inside["hi"])).groupBy(
        values[key].alias(key), "lo", "hi", "before", y.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    up = Window.partitionBy(key, "lo", "hi").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaf = leaf.withColumn("_end", F.col("before") + F.sum("_c").over(up)).withColumn("_start", F.col("_end") - F.col("_c"))
    e, x = exact.alias("e"), leaf.alias("x")
    ranked = e.join(x, (F.col(f"e.{key}") == F.col(f"x.{key}")) & (F.col("e.lo") == F.col("x.lo")) & (F.col("e.hi") == F.col("x.hi"))
                    & (F.col("e.r") >= F.col("x._start")) & (F.col("e.r") < F.col("x._end"))).select(f"e.{key}", "e._n", "e.r", "x._v")
    found = exact.filter("lo = hi").select(key, "_n", "r", F.col("lo").alias("_v")).unionByName(ranked)
    # At most two order statistics per probability and series, some found in two brackets: a small map.
    stats = found.groupBy(key, "_n").agg(F.map_from_entries(F.collect_set(F.struct("r", "_v"))).alias("_m"))
    cols = []
    for p, name in zip(probs, names):
        # Same arithmetic as Spark's percentile: (hi - h) * v_lo + (h - lo) * v_hi.
        h = (n - 1) * F.lit(float(p))
        lo_r, hi_r = F.floor(h).cast("long"), F.ceil(h).cast("long")
        v_lo, v_hi = F.try_element_at("_m", lo_r), F.try_element_at("_m", hi_r)
        cols.append(F.when(lo_r == hi_r, v_lo).otherwise(
            (hi_r.cast("double") - h) * v_lo + (h - lo_r.cast("double")) * v_hi).alias(name))
    return stats.select(key, *cols)
