"""One scan batch as a composition of R1-R6: what is left to scan, its rows, and their append.

The plan of a batch is two anti joins, one grouped minimum and one per-group limit on the header; points are
only read for the series that remain.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, EXCLUDED_COLLECTIONS, ScoreParams
from .increment import (append_scan, collection_error_rows, exclude_collections, first_per_key, limit_new, only_new,
                        skip_failed_collections)
from .scan import score_panel


def to_scan(header: DataFrame, previous: DataFrame | None = None, limit: int = 0,
            excluded=tuple(EXCLUDED_COLLECTIONS)) -> DataFrame:
    """Header rows of a batch: S7 exclusions, then R2 and R1 against ``previous``, R3 first of each id, R4 limit.

    The limit counts new series only, so repeated batches with a limit move through a collection.
    """
    out = exclude_collections(header, excluded)
    if previous is not None:
        out = only_new(skip_failed_collections(out, previous), previous)
    return limit_new(first_per_key(out).select(*header.columns), limit)


def scan_batch(header: DataFrame, panel: DataFrame, previous: DataFrame | None = None,
               failures: DataFrame | None = None, limit: int = 0, params: ScoreParams = DEFAULT,
               with_hash: bool = True) -> DataFrame:
    """Scan rows of one batch, with one R5 row for each of ``failures`` (source, collection, note).

    A ``panel`` with an ``ord`` column may hold several entries of one id: the points of the header row kept count.
    Without it each id has one series. A failed collection that ``previous`` already records gets no second row.
    """
    wanted = to_scan(header, previous, limit)
    if "ord" in panel.columns:
        keep = wanted.select(F.col("id").alias("_id"), F.col("ord").alias("_ord"))
        points = panel.join(keep, (F.col("id") == F.col("_id")) & F.col("ord").eqNullSafe(F.col("_ord")), "left_semi")
        points = points.drop("ord")
    else:
        points = panel.join(wanted.select("id"), "id", "left_semi")
    rows = score_panel(wanted, points, params, with_hash=with_hash)
    if failures is None:
        return rows
    errors = collection_error_rows(failures)
    return rows.unionByName(errors if previous is None else only_new(errors, previous))


def append_batch(path: str, header: DataFrame, panel: DataFrame, previous: DataFrame | None = None,
                 failures: DataFrame | None = None, limit: int = 0, params: ScoreParams = DEFAULT,
                 with_hash: bool = True, fmt: str = "parquet") -> None:
    """Score one batch and append its rows to the scan table at ``path``."""
    append_scan(scan_batch(header, panel, previous, failures, limit, params, with_hash), path, fmt)
