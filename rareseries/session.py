"""Session and checkpoint-directory helpers."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: naive timestamps compared in UTC, AQE on so
# skewed joins and small shuffles are re-planned at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of unreferenced DataFrames are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rareseries",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests, benches and examples."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("RARESERIES_DRIVER_MEMORY", "16g"),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table in the shared checkpoint folder and go on from there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str, rows: int = 100_000) -> DataFrame:
    """``df`` dealt by ``keys`` over tasks of ``rows`` rows on average: their number follows from the rows, not from their compressed bytes."""
    return df.repartition(max(1, -(-df.count() // rows)), *keys)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only where none is configured.

    On a cluster the shared folder named by ``spark.checkpoint.dir`` is used.
    Only a local-mode session without that setting gets a fresh folder under
    the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rareseries-ckpt-"))
    return sc.getCheckpointDir()
