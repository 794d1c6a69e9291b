"""Nested entries -> long panel.

An entry is one row ``(entry_ord, item_id, target)``; ``entry_ord`` is the
0-based position of the entry in its collection, counted over all entries,
malformed ones included.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import make_id
from ..operators.increment import first_series
from ..operators.profile import clean_values


def _lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def entry_key(item_id: str = "item_id", entry_ord: str = "entry_ord") -> Column:
    """``item_id`` when present (``0`` is a real key), else the entry's position."""
    return F.coalesce(F.col(item_id).cast("string"), F.col(entry_ord).cast("string"))


def split_malformed_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): an entry without a target array is skipped.

    An *empty* array is not malformed; it becomes a ``skipped_short`` series.
    """
    bad = F.col("target").isNull()
    return entries.filter(~bad), entries.filter(bad).withColumn(
        "note", F.lit("entry has no target array"))


def _well_formed(entries: DataFrame, collection, freq, source: str) -> DataFrame:
    e = entries.withColumn("_collection", _lit_or_col(collection).cast("string")) \
               .withColumn("_freq", _lit_or_col(freq).cast("string")) \
               .withColumn("_key", entry_key())
    good, _bad = split_malformed_entries(e)
    return good.withColumn("id", make_id(F.lit(source), F.col("_collection"), F.col("_key")))


def _header_cols(source: str) -> list:
    return [
        F.col("id"), F.lit(source).alias("source"), F.col("_collection").alias("collection"),
        F.col("_key").alias("name"), F.col("_freq").alias("granularity"),
        F.lit(None).cast("string").alias("time_column"), F.lit("float64").alias("dtype"),
    ]


def entry_header(entries: DataFrame, collection, freq=None, source: str = "gluonts") -> DataFrame:
    """Header rows (one per well-formed entry, ``ord`` = entry position).

    Only ``entry_ord``, ``item_id`` and whether ``target`` is NULL are read, so
    a caller may pass key columns with a stand-in ``target`` (the arrays need
    not travel to wherever the positions were computed).
    """
    good = _well_formed(entries, collection, freq, source)
    return good.select(*_header_cols(source), F.col("entry_ord").cast("long").alias("ord"))


def entry_points(entries: DataFrame, collection, freq=None, source: str = "gluonts", with_ord: bool = False) -> DataFrame:
    """Long panel rows: the target arrays exploded with their position, NaN -> NULL.

    ``entry_ord`` is only read for entries without ``item_id`` (the key fallback) and for ``with_ord``,
    which adds the entry's position as ``ord``.
    """
    good = _well_formed(entries, collection, freq, source)
    extra = [F.col("entry_ord").cast("long").alias("ord")] if with_ord else []
    panel = good.select(*_header_cols(source), *extra, F.posexplode("target").alias("pos", "value"))
    return clean_values(panel).select(
        "id", "source", "collection", "name", "granularity", "time_column", "dtype",
        F.col("pos").cast("long").alias("pos"), F.lit(None).cast("timestamp_ntz").alias("ts"), "value", *[c for c in ("ord",) if with_ord])


def panel_from_entries(entries: DataFrame, collection, freq=None, source: str = "gluonts"
                       ) -> tuple[DataFrame, DataFrame]:
    """(header, panel) of one series per well-formed entry.

    ``collection``/``freq`` are literals or Columns (one entries table may hold
    several collections). Values are exploded with their position; NaN
    becomes NULL. Of entries whose ids coincide (ids are lower-cased) the first by ``entry_ord`` counts.
    """
    return first_series(entry_header(entries, collection, freq, source),
                        entry_points(entries, collection, freq, source, with_ord=True))
