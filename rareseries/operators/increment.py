"""Incremental scan control.

Resuming is an anti join against the ids already in the scan table, so the
scan only reads the ``id`` column. Picking the first row of an id uses a
partially aggregated ``min_by``: even an id repeated in a third of all rows
is reduced map-side before the shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import make_id
from ..params import EXCLUDED_COLLECTIONS, NOTE_MAX_CHARS
from ..schemas import SCAN, SCAN_COLUMNS, published


def exclude_collections(header: DataFrame, excluded=tuple(EXCLUDED_COLLECTIONS), sources=None,
                        collections=None) -> DataFrame:
    """Drop excluded collections (a NULL collection stays); optionally keep only some sources / collections."""
    out = header.filter(F.coalesce(~F.col("collection").isin(*excluded), F.lit(True))) if excluded else header
    if sources:
        out = out.filter(F.col("source").isin(*sources))
    if collections:
        out = out.filter(F.col("collection").isin(*collections))
    return out


def only_new(header: DataFrame, previous: DataFrame, key: str = "id") -> DataFrame:
    """Series whose id is not in ``previous`` (any table with an ``id`` column)."""
    return header.join(previous.select(key).distinct(), key, "left_anti")


def skip_failed_collections(header: DataFrame, previous: DataFrame) -> DataFrame:
    """R2: drop every series of a collection whose ``source:collection:dataset`` id is recorded."""
    err = make_id(F.col("source"), F.col("collection"), F.lit("dataset"))
    failed = previous.select(F.col("id").alias("_err")).distinct()
    return header.withColumn("_err", err).join(failed, "_err", "left_anti").drop("_err")


def first_per_key(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """The first row of every key in ``order`` (ties broken by the full row).

    A NULL ``order`` comes last. ``min`` of a struct is an ordinary aggregate with map-side combining,
    so a key repeated millions of times costs one row per task before the shuffle.
    """
    cols = [c for c in df.columns if c != key]
    first = F.struct(F.col(order).isNull().alias("_null"), F.col(order).alias("_ord"), *[F.col(c) for c in cols])
    picked = df.groupBy(key).agg(F.min(first).alias("_r"))
    return picked.select(key, *[F.col("_r")[c].alias(c) for c in cols])


def first_series(header: DataFrame, panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """R3 for both tables: of entries whose ids coincide, the first by ``ord`` and only its points.

    ``panel`` carries the ``ord`` of the entry of each point; it is not in the panel returned.
    """
    kept = first_per_key(header)
    wanted = kept.select(F.col("id").alias("_id"), F.col("ord").alias("_ord"))
    same = (F.col("id") == F.col("_id")) & F.col("ord").eqNullSafe(F.col("_ord"))
    return kept.select(*header.columns), panel.join(wanted, same, "left_semi").drop("ord")


def limit_new(header: DataFrame, n: int, group: tuple[str, ...] = ("source", "collection"),
              order: str = "ord") -> DataFrame:
    """At most ``n`` series per collection in ``order`` (0 keeps all).

    ``row_number() <= n`` is planned with a partial per-group limit before the
    shuffle, so each task forwards at most ``n`` rows per group.
    """
    if not n:
        return header
    w = Window.partitionBy(*group).orderBy(F.col(order).asc_nulls_last(), F.col("id"))
    return header.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def collection_error_rows(failures: DataFrame) -> DataFrame:
    """One blank scan row per failed collection (``failures``: source, collection, note)."""
    cols = []
    for f in SCAN.fields:
        if f.name == "id":
            c = make_id(F.col("source"), F.col("collection"), F.lit("dataset"))
        elif f.name in ("source", "collection"):
            c = F.col(f.name)
        elif f.name == "status":
            c = F.lit("error")
        elif f.name == "note":
            c = F.substring(F.col("note"), 1, NOTE_MAX_CHARS)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return failures.select(*cols)


def append_scan(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append scan rows, partitioned by source and collection."""
    out = published(rows.select(*SCAN_COLUMNS)) if fmt == "csv" else rows.select(*SCAN_COLUMNS)
    w = out.write.mode("append").partitionBy("source", "collection")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


#: Buckets of a scan table by id; they must stay the same as long as a table is appended to.
SCAN_BUCKETS = 64


def append_scan_table(rows: DataFrame, table: str, path: str | None = None, buckets: int = SCAN_BUCKETS) -> None:
    """R6 into a catalog table in buckets of ``id``, sorted inside each.

    A resume (:func:`only_new` against ``spark.table(table)``) then moves the new header alone: the scan table meets it bucket by
    bucket, without a shuffle of its own, however many batches it holds. ``path`` places a table that does not exist yet.
    """
    w = rows.select(*SCAN_COLUMNS).repartition(buckets, "id").write.mode("append").bucketBy(buckets, "id").sortBy("id").format("parquet")
    (w.option("path", path) if path else w).saveAsTable(table)


def scan_summary(scan: DataFrame) -> DataFrame:
    """Total, counts per status, per level (NULL kept), and the ``n_rare > 0`` count.

    One pass: a grouping on ``(status, imbalance_level)`` whose few rows are
    then folded into the report rows ``(section, value, n)``.
    """
    g = scan.groupBy("status", "imbalance_level").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.coalesce(F.col("n_rare"), F.lit(0)) > 0).alias("_passed"))
    total = g.agg(F.sum("_n").alias("n")).select(F.lit("total").alias("section"),
                                                 F.lit(None).cast("string").alias("value"), "n")
    by_status = g.groupBy(F.col("status").alias("value")).agg(F.sum("_n").alias("n")).select(
        F.lit("status").alias("section"), "value", "n")
    by_level = g.groupBy(F.col("imbalance_level").alias("value")).agg(F.sum("_n").alias("n")).select(
        F.lit("imbalance_level").alias("section"), "value", "n")
    passed = g.agg(F.sum("_passed").alias("n")).select(F.lit("passed").alias("section"),
                                                       F.lit(None).cast("string").alias("value"), "n")
    out = total.unionByName(by_status).unionByName(by_level).unionByName(passed)
    return out.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))
