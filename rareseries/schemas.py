"""Explicit schemas of the tables the library reads and writes.

Internally the rare share is called ``pct_rare``; :func:`published` renames it
to ``%Rare`` at the sink.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


HEADER_FIELDS = ("id", "source", "collection", "name", "granularity", "time_column", "dtype")

# Long panel: one row per point of every series.
PANEL = _schema(
    ("id", S), ("source", S), ("collection", S), ("name", S), ("granularity", S),
    ("time_column", S), ("dtype", S), ("pos", L), ("ts", T.TimestampNTZType()), ("value", D),
)

# Series header: one row per series, including series without any point.
HEADER = _schema(*[(c, S) for c in HEADER_FIELDS], ("ord", L))

# Nested entries of one collection (a GluonTS-like source).
ENTRIES = _schema(("entry_ord", L), ("item_id", S), ("target", T.ArrayType(D)))

# The published columns of the scan and catalog tables, in their order.
SCAN = _schema(
    ("id", S), ("source", S), ("collection", S), ("name", S), ("granularity", S), ("time_column", S),
    ("length", L), ("dtype", S), ("content_hash", S),
    ("N", L), ("n_normal", L), ("n_rare", L), ("IR", D), ("pct_rare", D), ("imbalance_level", S),
    ("missing_pct", D), ("mean", D), ("std", D), ("cv", D), ("skewness", D), ("kurtosis", D),
    ("autocorr_lag1", D), ("status", S), ("note", S),
)

SCAN_COLUMNS = SCAN.names

SERIES_COLUMNS = [
    "id", "name", "source", "collection", "license",
    "granularity", "time_column", "length", "dtype", "size_bytes",
    "N", "n_normal", "n_rare", "IR", "pct_rare", "imbalance_level",
    "rel_thres", "rel_coef", "rel_xtrm_type", "k", "embed", "diff",
    "missing_pct", "mean", "std", "cv", "skewness", "kurtosis",
    "autocorr_lag1", "seasonal_period",
    "content_hash", "blob_path", "hf_revision", "pipeline_version", "ingested_at",
]

SCANNED_COLUMNS = ["id", "content_hash", "N", "n_rare", "pct_rare", "IR", "imbalance_level", "verdict"]

# Stored series (one table for all published series).
BLOB = _schema(
    ("source", S), ("collection", S), ("id", S), ("pos", L), ("ts", T.TimestampNTZType()),
    ("value", D), ("blob_path", S),
)


def published(df: DataFrame) -> DataFrame:
    """Rename internal column names to the published spelling."""
    return df.withColumnRenamed("pct_rare", "%Rare") if "pct_rare" in df.columns else df


def internal(df: DataFrame) -> DataFrame:
    """Inverse of :func:`published`."""
    return df.withColumnRenamed("%Rare", "pct_rare") if "%Rare" in df.columns else df
