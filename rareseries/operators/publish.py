"""Publishing accepted series to one partitioned table.

All stored series share one Parquet table partitioned by ``source`` and
``collection`` and sorted by ``id, pos`` inside each file, so a read of a
few ids prunes partitions and row groups. ``blob_path`` stays a logical
address column (the per-series path of the published layout); no file per
series and no directory per shard is created.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import blob_path
from ..schemas import BLOB
from ..session import spread, written
from .hashing import hash_check

BLOB_COLUMNS = ["source", "collection", "id", "pos", "ts", "value", "blob_path"]


def unpublished(catalog: DataFrame, collections=None) -> DataFrame:
    """Catalog rows without a blob yet, optionally for some collections."""
    out = catalog.filter(F.col("blob_path").isNull())
    return out.filter(F.col("collection").isin(*collections)) if collections else out


def select_wanted(panel: DataFrame, wanted: DataFrame) -> DataFrame:
    """The points of the wanted ids (broadcast semi join when the id list is small)."""
    ids = wanted.select("id").distinct()
    return panel.join(ids, "id", "left_semi")


def verify_hash(panel: DataFrame, catalog: DataFrame) -> DataFrame:
    """U4: per wanted id, whether the points hash to the catalog's ``content_hash``."""
    return hash_check(panel, catalog.select("id", "content_hash"))


def series_frame(panel: DataFrame) -> DataFrame:
    """What is stored per point: value (missing kept) and the timestamp when dated."""
    return panel.select("source", "collection", "id", "pos", "ts", "value", blob_path("id").alias("blob_path"))


def staged_ids(spark: SparkSession, root: str) -> DataFrame:
    if not _exists(spark, root):
        return spark.createDataFrame([], "id string")
    return spark.read.schema(BLOB).parquet(root).select("id").distinct()


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def stage_series(panel: DataFrame, catalog: DataFrame, root: str, strict: bool = True) -> DataFrame:
    """Append every wanted series whose hash matches and that is not yet staged.

    A mismatch writes nothing for that id; with ``strict`` it raises and
    writes nothing at all. Returns the verification table.
    """
    spark = panel.sparkSession
    wanted = select_wanted(panel, catalog)
    check = written(verify_hash(wanted, catalog))
    bad = check.filter(~F.col("hash_ok"))
    if strict:
        first = bad.select("id").orderBy("id").limit(5).collect()
        if first:
            raise ValueError("nothing staged; points and catalog differ in content_hash for "
                             + ", ".join(r["id"] for r in first))
    good = check.filter(F.col("hash_ok")).select("id")
    todo = good.join(staged_ids(spark, root), "id", "left_anti")
    rows = series_frame(wanted.join(todo, "id", "left_semi"))
    (rows.repartitionByRange("source", "collection", "id", "pos")
         .sortWithinPartitions("source", "collection", "id", "pos")
         .write.mode("append").partitionBy("source", "collection").parquet(root))
    return check


def blob_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Logical bytes per staged series (8 per value, 8 per timestamp)."""
    stored = spark.read.schema(BLOB).parquet(root)
    return stored.groupBy("id").agg(
        (F.lit(8) * F.count(F.lit(1)) + F.lit(8) * F.count("ts")).cast("long").alias("size_bytes"))


def missing_from_source(wanted: DataFrame, panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U8: wanted ids the source did not yield, and staged/wanted counts per collection."""
    present = panel.select("id").distinct()
    missing = wanted.select("id", "source", "collection").join(present, "id", "left_anti")
    counts = (wanted.select("id", "source", "collection")
              .join(present.withColumn("_found", F.lit(1)), "id", "left")
              .groupBy("source", "collection")
              .agg(F.count("_found").alias("staged"), F.count(F.lit(1)).alias("wanted")))
    return missing, counts


def path_collisions(ids: DataFrame) -> DataFrame:
    """Blob paths shared by more than one id (must be empty).

    Rows meet by path in as many tasks as their number asks for; no task gathers the rows of its input before that.
    """
    rows = spread(ids.select("id", blob_path("id").alias("blob_path")), "blob_path")
    return (rows.distinct()
            .groupBy("blob_path").agg(F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("first_id"),
                                      F.max("id").alias("last_id"))
            .filter(F.col("n_ids") > 1))


def finalize_catalog(catalog: DataFrame, sizes: DataFrame, revision: str, pipeline_version: str,
                     ingested_at: str) -> DataFrame:
    """Fill the five publish columns for ids in ``sizes``; leave the rest untouched."""
    s = sizes.select("id", F.col("size_bytes").alias("_size"), F.lit(True).alias("_pub"))
    j = catalog.join(s, "id", "left")
    pub = F.col("_pub").isNotNull()
    fills = {
        "blob_path": blob_path("id"),
        "size_bytes": F.col("_size").cast("long"),
        "hf_revision": F.lit(revision),
        "pipeline_version": F.lit(pipeline_version),
        "ingested_at": F.lit(ingested_at),
    }
    out = j
    for c, v in fills.items():
        out = out.withColumn(c, F.when(pub, v).otherwise(F.col(c)))
    return out.select(*catalog.columns)
