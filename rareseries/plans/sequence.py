"""Order-dependent steps that stay balanced when one series is huge.

Every step here needs the points of a series in order: dense positions,
positions among non-missing values, the previous non-missing value. A window
partitioned by series id would put a whole series in one task. These helpers
cut long series into sampled ranges or into chunks of at most ``chunk_rows``
rows, work on each of them, and stitch them together with a prefix sum over a
small table of ranges or chunks.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import DEFAULT
from ..session import written
from .joins import CHUNK

_UNB = Window.unboundedPreceding


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the right side's keys are dropped."""
    right = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    return left.join(right, cond, how).drop(*[f"_k_{c}" for c in keys])


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str = "pos",
                chunk_rows: int = DEFAULT.chunk_rows) -> DataFrame:
    """Add ``out`` = 0-based row number inside ``keys`` following ``order``.

    Equal to ``row_number() over (partition by keys order by order) - 1``. Keys of up to ``chunk_rows`` rows take that window. The
    rows of longer keys are sorted by sample: Spark draws splitters from all their sort columns, so that neither a burst of equal timestamps
    nor a hot key fills one range; each range is sorted and written once with the place of every row. What a range adds to a key is
    the prefix sum of the key's counts in the ranges before, a few rows a key. ``order`` must be a total order inside each key
    for the result to be deterministic; NULLs sort last. A NULL key is a key like any other.
    """
    ordered = [F.col(c).asc_nulls_last() for c in order]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = sizes.filter(F.col("_n") > chunk_rows)
    total = hot.agg(F.sum("_n")).first()[0]
    window = Window.partitionBy(*keys).orderBy(*ordered)
    if not total:
        return df.withColumn(out, (F.row_number().over(window) - 1).cast("long"))
    hot = hot.select(*keys)
    cold = _same_keys(df, hot, keys, "left_anti").withColumn(out, (F.row_number().over(window) - 1).cast("long"))
    by_all = [F.col(c).asc_nulls_last() for c in keys] + ordered
    ranges = 2 * -(-total // chunk_rows)
    rows = _same_keys(df, hot, keys, "left_semi").repartitionByRange(ranges, *by_all).sortWithinPartitions(*by_all)
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()))  # range number times 2^33, and the place in the range
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    runs = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(_UNB, -1)
    runs = runs.select(*keys, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    rows = _same_keys(rows, runs, [*keys, "_range"], "inner")
    return cold.unionByName(rows.withColumn(out, (F.col("_off") + F.col("_at")).cast("long")).drop("_at", "_range", "_off"))


def compact(panel: DataFrame, chunk_rows: int = DEFAULT.chunk_rows, key: str = "id") -> DataFrame:
    """Positions among non-missing values and the previous non-missing value.

    Input needs ``key, pos, value`` with ``pos`` dense from 0. Adds ``_chunk``
    (= ``pos div chunk_rows``), ``cpos`` (0-based rank among non-null values,
    NULL on missing points) and ``prev`` (the previous non-null value, NULL for
    the first one and on missing points).
    """
    p = panel.withColumn(CHUNK, F.floor(F.col("pos") / F.lit(chunk_rows)).cast("long"))
    w = Window.partitionBy(key, CHUNK).orderBy("pos")
    p = (p.withColumn("_cnt", F.count("value").over(w.rowsBetween(_UNB, 0)))
          .withColumn("_lprev", F.last("value", ignorenulls=True).over(w.rowsBetween(_UNB, -1))))
    per_chunk = p.groupBy(key, CHUNK).agg(
        F.count("value").alias("_nn"),
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col("pos"))).alias("_last"))
    wc = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(_UNB, -1)
    per_chunk = per_chunk.select(
        key, CHUNK,
        F.coalesce(F.sum("_nn").over(wc), F.lit(0)).alias("_off"),
        F.last("_last", ignorenulls=True).over(wc).alias("_plast"))
    p = _same_keys(p, per_chunk, [key, CHUNK], "inner")
    has = F.col("value").isNotNull()
    return (p.withColumn("cpos", F.when(has, F.col("_off") + F.col("_cnt") - 1).cast("long"))
             .withColumn("prev", F.when(has, F.coalesce(F.col("_lprev"), F.col("_plast"))))
             .drop("_cnt", "_lprev", "_off", "_plast"))
