"""Scan batches (R1-R6, S7) and the way of a series through the store."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rareseries.operators.batch import append_batch, scan_batch, to_scan
from rareseries.operators.catalog import build_series
from rareseries.operators.publish import finalize_catalog, blob_sizes, stage_series
from rareseries.operators.retrieve import pull, read_series
from rareseries.params import EXCLUDED_COLLECTIONS
from rareseries.sources.entries import entry_header, entry_points
from rareseries.sources.tables import read_scan_results

LONG = [float(i % 7) for i in range(60)] + [90.0, 95.0, 1.0, 2.0]


def entries(spark, rows):
    """(header, points with the entry's ord) of rows (collection, position, key, target)."""
    df = spark.createDataFrame(rows, "collection string, entry_ord long, item_id string, target array<double>")
    return entry_header(df, F.col("collection")), entry_points(df, F.col("collection"), with_ord=True)


def test_header_left_to_scan(spark):
    out = next(iter(EXCLUDED_COLLECTIONS))
    rows = [("one", i, k, LONG) for i, k in enumerate(["A", "b", "a", "c", "d"])]
    rows += [("two", 0, "x", LONG), (out, 0, "x", LONG), (None, 0, "n", LONG)]
    header, _ = entries(spark, rows)
    done = spark.createDataFrame([("gluonts:one:b",), ("gluonts:two:dataset",)], "id string")
    got = {(r["collection"], r["ord"]) for r in to_scan(header, done).collect()}
    assert got == {("one", 0), ("one", 3), ("one", 4), (None, 0)}
    limited = {(r["collection"], r["ord"]) for r in to_scan(header, done, limit=2).collect()}
    assert limited == {("one", 0), ("one", 3), (None, 0)}


def test_coinciding_ids_keep_the_points_of_the_first(spark):
    header, points = entries(spark, [("one", 0, "A", LONG), ("one", 1, "a", LONG[:20])])
    rows = scan_batch(header, points).collect()
    assert [(r["id"], r["length"]) for r in rows] == [("gluonts:one:a", len(LONG))]


def test_batches_append_each_series_and_failure_once(spark, tmp_path):
    path = str(tmp_path / "scan")
    header, points = entries(spark, [("one", i, str(i), LONG[i:]) for i in range(5)])
    failures = spark.createDataFrame([("gluonts", "two", "x" * 5000)], "source string, collection string, note string")
    append_batch(path, header, points, failures=failures, limit=2)
    append_batch(path, header, points, read_scan_results(spark, path, "parquet"), failures, limit=2)
    append_batch(path, header, points, read_scan_results(spark, path, "parquet"), failures)
    rows = read_scan_results(spark, path, "parquet").collect()
    assert sorted(r["id"] for r in rows) == [f"gluonts:one:{i}" for i in range(5)] + ["gluonts:two:dataset"]
    assert {r["status"] for r in rows if r["collection"] == "two"} == {"error"}


def test_from_scan_to_pulled_series(spark, tmp_path):
    path = str(tmp_path / "store")
    header, points = entries(spark, [("one", i, str(i), LONG[i:]) for i in range(3)])
    points = points.drop("ord")
    catalog = build_series(scan_batch(header, points))
    assert catalog.count() == 3
    stage_series(points, catalog, path)
    stage_series(points, catalog, path)  # nothing is stored twice
    done = finalize_catalog(catalog, blob_sizes(spark, path), "r1", "0.2", "2026-02-03")
    stored = read_series(spark, path, collections=["one"])
    assert "PartitionFilters: [isnotnull(collection" in stored._jdf.queryExecution().toString()
    got = pull("gluonts:one:1", done, stored).orderBy("pos").collect()
    assert [r["value"] for r in got] == LONG[1:]
    altered = stored.withColumn("value", F.col("value") + F.when(F.col("pos") == 3, 1).otherwise(0))
    with pytest.raises(ValueError, match="content_hash"):
        pull("gluonts:one:1", done, altered)
