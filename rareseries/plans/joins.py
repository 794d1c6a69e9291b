"""Join helpers: size-checked broadcasts and joins salted by chunk.

A per-series table (one row per id) joined to the point rows of its series
would send every point of a hot series to one reducer. Instead the small
table is replicated to each ``(id, _chunk)`` pair that occurs in the big
table, and the join runs on ``(id, _chunk)``. A chunk never holds more than
``chunk_rows`` points, so no reducer receives more than that from one series.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a table whose size depends on data that we ever broadcast: ids and a few numbers, some 256 bytes each.
MAX_BROADCAST_BYTES, ROW_BYTES = 8 << 20, 256
MAX_BROADCAST_ROWS = MAX_BROADCAST_BYTES // ROW_BYTES

CHUNK = "_chunk"


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """``df``, marked for broadcast if its rows are few enough for ``MAX_BROADCAST_BYTES``, and their number.

    The count is a real check (one small job). Beyond the bound the plain
    DataFrame comes back and the caller's join is planned normally (sort-merge,
    with AQE splitting skewed partitions).
    """
    n = df.count()
    return (F.broadcast(df) if n <= max_rows else df), n


def chunk_keys(big: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ``(key, _chunk)`` pairs of a chunked table (partially aggregated)."""
    return big.select(key, CHUNK).distinct()


def salted_attach(big: DataFrame, per_key: DataFrame, chunks: DataFrame, key: str = "id",
                  how: str = "inner") -> DataFrame:
    """Attach the columns of ``per_key`` (one row per key) to every row of ``big``.

    ``big`` must carry ``_chunk``; ``chunks`` are its distinct ``(key, _chunk)``
    pairs. Both helper tables are small: one row per series, plus one per extra
    chunk of a long series.
    """
    replicated = chunks.join(per_key, key, "inner")
    return big.join(replicated, [key, CHUNK], how)
