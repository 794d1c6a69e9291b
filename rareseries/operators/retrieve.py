"""Retrieve stored series by id with integrity checks.

Requested ids are a DataFrame (``id`` plus the request order ``ord``), so a
request of millions of ids is a join, not a driver loop. The result is one
long DataFrame ``(ord, id, pos, ts, value)``; nothing is collected unless the
caller asks for ``errors="raise"``, which needs one small action on the
status table.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import unsafe_path
from ..plans.joins import broadcast_if_small
from ..schemas import BLOB
from ..session import written
from .hashing import hash_check, stream_hashes

ERRORS = ("raise", "skip")


def request_frame(spark: SparkSession, ids: Iterable[str]) -> DataFrame:
    """A small explicit id list as a request DataFrame (order kept)."""
    return spark.createDataFrame([(i, str(x)) for i, x in enumerate(ids)], "ord long, id string")


def dedupe_requests(requests: DataFrame) -> DataFrame:
    """Repeated ids are fetched once, at their first position."""
    return requests.groupBy("id").agg(F.min("ord").alias("ord"))


#: Columns that place a series in the store; both the catalog and the store have them, as functions of the id.
ROUTE = ("source", "collection")


def _candidates(requests: DataFrame, catalog: DataFrame, stored: DataFrame) -> tuple[DataFrame, list[str]]:
    """Distinct requests with what the catalog knows of them, and the columns by which they meet the store."""
    route = [c for c in ROUTE if c in catalog.columns and c in stored.columns]
    cat = catalog.select("id", "blob_path", "content_hash", *route).withColumn("_known", F.lit(True))
    j = dedupe_requests(requests).join(cat, "id", "left")
    state = (F.when(F.col("_known").isNull(), "unknown_id")
              .when(F.col("blob_path").isNull(), "no_blob")
              .when(unsafe_path("blob_path"), "unsafe_path")
              .otherwise("stored"))
    return written(j.select("ord", "id", "blob_path", "content_hash", *route, state.alias("state"))), ["id", *route]


def _points(candidates: DataFrame, on: list[str], stored: DataFrame) -> DataFrame:
    """The stored points of the candidates. They meet by id and by the columns that the store is partitioned by, so that the
    scan reads the partitions of the wanted series only (a dynamic filter while the candidates are a broadcast)."""
    wanted, _ = broadcast_if_small(candidates.filter("state = 'stored'").select(*on))
    return stored.join(wanted, on, "inner")


def _checked(candidates: DataFrame, points: DataFrame) -> DataFrame:
    """Candidates with the hash of their points, from one ordered stream; no hash where nothing is stored."""
    return candidates.join(stream_hashes(points), "id", "left")


def _status() -> F.Column:
    wrong = F.col("actual").isNull() | (F.col("actual") != F.coalesce("content_hash", F.lit("")))
    return F.when(F.col("state") != "stored", F.col("state")).when(wrong, "hash_mismatch").otherwise("ok").alias("status")


def pull_status(requests: DataFrame, catalog: DataFrame, stored: DataFrame) -> DataFrame:
    """``ord, id, status, blob_path`` per distinct requested id.

    status: ``unknown_id`` (not in catalog), ``no_blob`` (no blob_path),
    ``unsafe_path`` (G4), ``hash_mismatch`` (G5: stored non-null values do
    not hash to the catalog hash), else ``ok``. The points move once, to the task that hashes their series.
    """
    candidates, on = _candidates(requests, catalog, stored)
    return _checked(candidates, _points(candidates, on, stored)).select("ord", "id", _status(), "blob_path")


_MESSAGES = {
    "unknown_id": (KeyError, "{} is not a catalog id"),
    "no_blob": (ValueError, "{} is not published yet (its blob_path is null)"),
    "unsafe_path": (ValueError, "{} has a blob_path outside the store"),
    "hash_mismatch": (ValueError, "{}: the stored points do not have the content_hash of the catalog"),
}


def pull_many(requests: DataFrame, catalog: DataFrame, stored: DataFrame, errors: str = "raise", ordered: bool = True) -> DataFrame:
    """Points of every requested id, ``(ord, id, pos, ts, value)``, by request then position if ``ordered``.

    ``raise`` fails on the first bad id in request order; ``skip`` returns
    only the ids that passed.
    """
    if errors not in ERRORS:
        raise ValueError(f"errors must be 'raise' or 'skip', got {errors!r}")
    candidates, on = _candidates(requests, catalog, stored)
    points = _points(candidates, on, stored)
    status = written(_checked(candidates, points).select("ord", "id", _status(), *on[1:]))  # hashed once, for the check and for the result
    if errors == "raise":
        bad = status.filter(F.col("status") != "ok").orderBy("ord").limit(1).collect()
        if bad:
            exc, msg = _MESSAGES[bad[0]["status"]]
            raise exc(msg.format(bad[0]["id"]))
    ok, _ = broadcast_if_small(status.filter(F.col("status") == "ok").select("ord", *on))
    out = stored.join(ok, on, "inner").select("ord", "id", "pos", "ts", "value")
    return out.orderBy("ord", "pos") if ordered else out


def pull(series_id: str, catalog: DataFrame, stored: DataFrame) -> DataFrame:
    """G1: one series, ordered by position; errors as in :func:`pull_many` with ``raise``.

    The id and its catalog row give the place in the store as constants, so one partition and the row groups with the id are read.
    """
    spark = catalog.sparkSession
    row = catalog.filter(F.col("id") == series_id)
    place = stored.filter(F.col("id") == series_id)
    route = [c for c in ROUTE if c in catalog.columns and c in stored.columns]
    found = row.select(*route).first() if route else None
    for c in route if found else []:
        place = place.filter(F.col(c).eqNullSafe(F.lit(found[c])))
    out = pull_many(request_frame(spark, [series_id]), row, place, "raise")
    return out.select("pos", "ts", "value")


def verify_pulled(points: DataFrame, catalog: DataFrame) -> DataFrame:
    """For every pulled id, whether its non-null values hash to the catalog hash."""
    return hash_check(points, catalog.select("id", "content_hash"))


def read_series(spark: SparkSession, root: str, sources=None, collections=None) -> DataFrame:
    """The stored series table, pruned to the given partitions."""
    df = spark.read.schema(BLOB).parquet(root)
    if sources:
        df = df.filter(F.col("source").isin(*sources))
    if collections:
        df = df.filter(F.col("collection").isin(*collections))
    return df
