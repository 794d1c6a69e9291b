"""Incremental scan as a Structured Streaming job (R1 + R6 on a stream).

New entry files landing in a folder are picked up by a file-source stream;
each micro-batch is turned into a panel, reduced to ids the scan table does
not hold yet (so a replayed batch after a failure appends nothing twice),
scored and appended. The stream checkpoint records which files were done,
which replaces the resume set of a batch rescan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.increment import append_scan, only_new
from ..operators.scan import score_panel
from ..params import DEFAULT, ScoreParams
from ..schemas import ENTRIES, SCAN

# Entry files carry the collection and its frequency next to each entry.
ENTRY_FILE = T.StructType(ENTRIES.fields + [T.StructField("collection", T.StringType(), True),
                                            T.StructField("freq", T.StringType(), True)])


def _scanned_ids(spark: SparkSession, out_path: str, collections: DataFrame) -> DataFrame:
    """Ids already in the scan table, read only from the batch's collections.

    The scan table is partitioned by source and collection, so the semi join on
    ``collection`` lets partition pruning skip every other collection.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(out_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "id string")  # nothing written yet; any other fault is raised
    done = spark.read.schema(SCAN).parquet(out_path)
    return done.join(collections, "collection", "left_semi").select("id")


def score_entries_batch(batch: DataFrame, out_path: str, source: str = "gluonts",
                        params: ScoreParams = DEFAULT) -> None:
    """Score one batch of entries and append the rows of ids not scanned before."""
    from ..sources.entries import panel_from_entries

    spark = batch.sparkSession
    header, panel = panel_from_entries(batch, F.col("collection"), F.col("freq"), source)
    header = only_new(header, _scanned_ids(spark, out_path, header.select("collection").distinct()))
    panel = panel.join(header.select("id"), "id", "left_semi")
    append_scan(score_panel(header, panel, params), out_path)


def start_entry_scan(spark: SparkSession, entries_dir: str, out_path: str, checkpoint: str,
                     source: str = "gluonts", params: ScoreParams = DEFAULT,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.schema(ENTRY_FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(entries_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, _epoch: score_entries_batch(df, out_path, source, params))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
