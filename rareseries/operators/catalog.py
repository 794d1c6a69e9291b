"""Catalog build (B1-B9) and versioned catalog reads."""
from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import normalize_granularity, seasonal_period
from ..functions.levels import license_of
from ..params import DEFAULT, ScoreParams
from ..schemas import SCANNED_COLUMNS, SERIES_COLUMNS
from .increment import first_per_key

PUBLISH_COLUMNS = {"size_bytes": "long", "blob_path": "string", "hf_revision": "string",
                   "pipeline_version": "string", "ingested_at": "string"}


def dedupe_first(scan: DataFrame, order: str = "ord") -> DataFrame:
    """B1: keep the first row of every id in scan order."""
    return first_per_key(scan, "id", order)


def duplicate_report(scan: DataFrame) -> DataFrame:
    """B2: ids that occur more than once, with how many rows dedupe drops for each."""
    return (scan.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1)
            .withColumn("n_dropped", F.col("n_rows") - 1))


def accepted() -> F.Column:
    """``status = 'ok' AND n_rare > 0``; NULLs are not accepted."""
    return F.coalesce((F.col("status") == "ok") & (F.col("n_rare") > 0), F.lit(False))


def build_series(scan: DataFrame, params: ScoreParams = DEFAULT, sort: bool = True) -> DataFrame:
    """Accepted series with the 35 catalog columns (publish columns NULL)."""
    s = scan.filter(accepted()).withColumn("granularity", normalize_granularity("granularity"))
    s = (s.withColumn("license", license_of("source", "collection"))
          .withColumn("rel_thres", F.lit(params.rel_thres))
          .withColumn("rel_coef", F.lit(params.rel_coef))
          .withColumn("rel_xtrm_type", F.lit(params.rel_xtrm_type))
          .withColumn("k", F.lit(params.k).cast("long"))
          .withColumn("embed", F.lit(params.embed))
          .withColumn("diff", F.lit(params.diff))
          .withColumn("seasonal_period", seasonal_period("granularity")))
    for c, t in PUBLISH_COLUMNS.items():
        s = s.withColumn(c, F.lit(None).cast(t))
    s = s.select(*SERIES_COLUMNS)
    return s.orderBy("id") if sort else s


def build_scanned(scan: DataFrame, sort: bool = True) -> DataFrame:
    """Every scanned row (not normalised) with its verdict."""
    s = scan.withColumn("verdict", F.when(accepted(), "accepted").otherwise("rejected")).select(*SCANNED_COLUMNS)
    return s.orderBy("id") if sort else s


def build_catalog(scan: DataFrame, params: ScoreParams = DEFAULT, order: str | None = "ord"
                  ) -> tuple[DataFrame, DataFrame]:
    """Dedupe (when an order column exists) and split into ``(series, scanned)``."""
    deduped = dedupe_first(scan, order) if order and order in scan.columns else scan
    return build_series(deduped, params), build_scanned(deduped)


VERSION_SCHEMA = "version string, published_at string, series string, scanned string"


def _hadoop(spark: SparkSession, path: str):
    """(file system of ``path``, Hadoop's file classes)."""
    fs = spark._jvm.org.apache.hadoop.fs
    return fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), fs


def commit_version(spark: SparkSession, root: str, record: dict[str, str]) -> None:
    """Publish a version by its record, put there whole and only if no other record has its name.

    The record is written under a name of its own and renamed without replacing, which the file system does in one step.
    """
    _, fs = _hadoop(spark, root)
    jvm = spark._jvm
    target = fs.Path(f"{root.rstrip('/')}/versions/{quote(record['version'], safe='')}.json")
    attempt = fs.Path(f"{root.rstrip('/')}/attempts/{uuid.uuid4().hex}.json")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    out = files.create(attempt, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    try:
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(attempt, target, options)
    except Py4JJavaError as e:
        files.delete(attempt, False)
        if files.exists(target):
            raise FileExistsError(f"catalog version {record['version']} is already published under {root}") from e
        raise


def write_catalog(series: DataFrame, scanned: DataFrame, root: str, version: str, published_at: str) -> None:
    """B9 sink: both tables under ``root`` as one version, which readers see whole or not at all.

    The tables go to folders of their own; the version's record, written last, names them. A published version never changes:
    a second write of it fails and leaves the first as it is. What a failed write leaves behind no record names.
    """
    spark = series.sparkSession
    fs, names = _hadoop(spark, root)
    if fs.exists(names.Path(f"{root.rstrip('/')}/versions/{quote(version, safe='')}.json")):
        raise FileExistsError(f"catalog version {version} is already published under {root}")
    record = {"version": version, "published_at": published_at}
    for name, df in (("series", series), ("scanned", scanned)):
        record[name] = f"tables/{uuid.uuid4().hex}-{name}"
        df.write.parquet(f"{root.rstrip('/')}/{record[name]}")
    commit_version(spark, root, record)


def _records(spark: SparkSession, root: str) -> DataFrame:
    folder = f"{root.rstrip('/')}/versions"
    fs, names = _hadoop(spark, root)
    if not fs.exists(names.Path(folder)):
        return spark.createDataFrame([], VERSION_SCHEMA)
    return spark.read.schema(VERSION_SCHEMA).json(folder)


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """``(version, published_at)`` of every published catalog version."""
    return _records(spark, root).select("version", "published_at")


def load_catalog(spark: SparkSession, root: str, version: str = "latest", table: str = "series",
                 refresh: bool = False) -> DataFrame:
    """A pinned version is immutable; ``latest`` is resolved on every call.

    Versions are strings (1.1 is not 1.10); only their records say what is published.
    """
    if refresh or version == "latest":
        spark.catalog.refreshByPath(f"{root.rstrip('/')}/versions")
    records = _records(spark, root)
    wanted = records if version == "latest" else records.filter(F.col("version") == version)
    found = wanted.orderBy(F.col("published_at").desc(), F.col("version").desc()).first()
    if found is None:
        raise FileNotFoundError(f"no published catalog version {version} under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{found[table]}")
