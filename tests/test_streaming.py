"""The incremental scan stream: new files are scored once; replays append nothing twice."""
from __future__ import annotations

import os
import tempfile

from rareseries.streaming.ingest import ENTRY_FILE, score_entries_batch, start_entry_scan


def _write(spark, folder, name, rows):
    """Land one entry file in the watched folder."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    cols = list(zip(*rows))
    table = pa.table({"entry_ord": pa.array(cols[0], pa.int64()), "item_id": pa.array(cols[1], pa.string()),
                      "target": pa.array(cols[2], pa.list_(pa.float64())),
                      "collection": pa.array(cols[3], pa.string()), "freq": pa.array(cols[4], pa.string())})
    pq.write_table(table, os.path.join(folder, f"{name}.parquet"))


def test_stream_scores_new_entries_once(spark):
    base = tempfile.mkdtemp(prefix="rs-stream-")
    src, out, ckpt = (os.path.join(base, d) for d in ("in", "scan", "ckpt"))
    os.makedirs(src)
    series = [float((i * 7) % 11) for i in range(30)] + [90.0]
    _write(spark, src, "a", [(0, "s1", series, "c1", "D"), (1, None, [1.0, 2.0], "c1", "D")])
    start_entry_scan(spark, src, out, ckpt).awaitTermination()
    first = {r["id"]: r["status"] for r in spark.read.parquet(out).collect()}
    assert first == {"gluonts:c1:s1": "ok", "gluonts:c1:1": "skipped_short"}

    _write(spark, src, "b", [(2, "s2", series[::-1], "c1", "D"), (0, "s1", series, "c1", "D")])
    start_entry_scan(spark, src, out, ckpt).awaitTermination()
    ids = [r["id"] for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == ["gluonts:c1:1", "gluonts:c1:s1", "gluonts:c1:s2"]

    # Replaying a batch (as after a failure) appends nothing.
    batch = spark.read.schema(ENTRY_FILE).parquet(os.path.join(src, "b.parquet"))
    score_entries_batch(batch, out)
    assert spark.read.parquet(out).count() == 3
