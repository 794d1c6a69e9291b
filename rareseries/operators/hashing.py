"""Content hash of a series (P5) and hash checks.

The hash is SHA-256 over the non-null values as consecutive little-endian
float64 bytes in series order, truncated to 16 hex digits. SHA-256 is a
sequential function of its input, so one series is hashed by one task; the
task streams it in Arrow batches (constant memory) after Spark has
hash-partitioned by id and sorted by position. Spark never materialises a
series as one array.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import EMPTY_HASH

HASH_SCHEMA = "id string, content_hash string"


def _stream_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash runs of equal ids; rows must arrive clustered by id and sorted by position.

    The order is checked as it streams (ids never decrease, positions strictly
    increase inside an id), so a plan that broke it fails instead of hashing
    silently wrong.
    """
    cur_id, hasher, last_pos = None, None, None
    for pdf in batches:
        if pdf.empty:
            continue
        ids = pdf["id"].to_numpy()
        vals = pdf["value"].to_numpy(dtype="<f8")
        there = ~np.isnan(vals)  # a missing value keeps its series in the stream and is not hashed
        pos = pdf["pos"].to_numpy()
        same = ids[1:] == ids[:-1]
        if (cur_id is not None and ids[0] < cur_id) or (ids[1:] < ids[:-1]).any() \
                or (cur_id == ids[0] and last_pos is not None and pos[0] <= last_pos) \
                or (same & (pos[1:] <= pos[:-1])).any():
            raise RuntimeError("content hash input is not clustered by id and sorted by pos")
        last_pos = pos[-1]
        # Start of every run of equal ids inside this batch (rows are sorted by id).
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ends = np.r_[starts[1:], len(ids)]
        done_ids, done_hashes = [], []
        for s, e in zip(starts, ends):
            rid = ids[s]
            if rid != cur_id:
                if hasher is not None:
                    done_ids.append(cur_id)
                    done_hashes.append(hasher.hexdigest()[:16])
                cur_id, hasher = rid, hashlib.sha256()
            hasher.update(np.ascontiguousarray(vals[s:e][there[s:e]]).tobytes())
        if done_ids:
            yield pd.DataFrame({"id": done_ids, "content_hash": done_hashes})
    if hasher is not None:
        yield pd.DataFrame({"id": [cur_id], "content_hash": [hasher.hexdigest()[:16]]})


def hashes_of_ordered(points: DataFrame) -> DataFrame:
    """Stream hashes over ``id, pos, value`` rows that are already hash-partitioned by
    id and sorted by ``(id, pos)`` (the output of a window on ``id`` ordered by ``pos``).

    Extra columns pass to Python untouched; a window output column among them
    keeps that window (and its exchange and sort) in the plan."""
    return points.mapInPandas(_stream_hashes, HASH_SCHEMA)


def content_hashes(panel: DataFrame, key: str = "id") -> DataFrame:
    """``(id, content_hash)`` for every series with at least one non-null value."""
    clean = panel.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(F.col(key).alias("id"), "pos", "value")
    ordered = clean.repartition("id").sortWithinPartitions("id", "pos")
    out = ordered.mapInPandas(_stream_hashes, HASH_SCHEMA)
    return out if key == "id" else out.withColumnRenamed("id", key)


def stream_hashes(points: DataFrame) -> DataFrame:
    """``(id, actual)`` of every id that has points, with or without values: one shuffle on ``id`` and one ordered stream."""
    ordered = points.select("id", "pos", "value").repartition("id").sortWithinPartitions("id", "pos")
    return ordered.mapInPandas(_stream_hashes, HASH_SCHEMA).withColumnRenamed("content_hash", "actual")


def with_empty_hash(col: str = "content_hash") -> F.Column:
    """A series without non-null values hashes to sha256(b'')[:16]."""
    return F.coalesce(F.col(col), F.lit(EMPTY_HASH))


def hash_check(panel: DataFrame, expected: DataFrame, key: str = "id") -> DataFrame:
    """Compare the hash of the given points with ``expected(id, content_hash)``.

    Returns ``id, expected_hash, actual_hash, hash_ok`` for every expected id
    that has points in ``panel`` (missing values are ignored, as in the hash).
    """
    actual = stream_hashes(panel.withColumnRenamed(key, "id")).select(F.col("id").alias(key), F.col("actual").alias("actual_hash"))
    out = expected.select(key, F.col("content_hash").alias("expected_hash")).join(actual, key, "inner")
    return out.withColumn("hash_ok", F.col("actual_hash") == F.col("expected_hash"))
