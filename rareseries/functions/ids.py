"""Series ids, blob paths and path safety as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def make_id(source, collection, key) -> Column:
    """``source:collection:key`` lower-cased with spaces turned into ``-``."""
    raw = F.concat_ws(":", _c(source).cast("string"), _c(collection).cast("string"), _c(key).cast("string"))
    return F.replace(F.lower(raw), F.lit(" "), F.lit("-"))


def split_id(id_) -> Column:
    """Array ``[source, collection, key]``: split at the first two ``:`` only."""
    return F.split(_c(id_), ":", 3)


def id_part(id_, i: int) -> Column:
    """Part ``i`` of an id (NULL when the id has fewer parts)."""
    return F.get(split_id(id_), i)


def blob_path(id_) -> Column:
    """``source/collection/<md5(id)[:2]>/<key with [^a-z0-9._-] -> '-'>.parquet``."""
    safe_key = F.regexp_replace(id_part(id_, 2), r"[^a-z0-9._-]", "-")
    shard = F.substring(F.md5(_c(id_)), 1, 2)
    return F.concat_ws("/", id_part(id_, 0), id_part(id_, 1), shard, F.concat(safe_key, F.lit(".parquet")))


def unsafe_path(path) -> Column:
    """True for an absolute path, or one whose normal form is ``..`` or starts with ``../``.

    Walking the ``/``-separated parts, ``..`` lowers the depth and any other
    non-empty part except ``.`` raises it; the normal form escapes the root
    exactly when the running depth ever drops below zero.
    """
    p = _c(path)
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("low"))

    def step(acc, part):
        d = (F.when(part == "..", acc["d"] - 1)
              .when((part == "") | (part == "."), acc["d"])
              .otherwise(acc["d"] + 1))
        return F.struct(d.alias("d"), F.least(acc["low"], d).alias("low"))

    walked = F.aggregate(F.split(p, "/"), init, step)
    return p.startswith("/") | (walked["low"] < 0)
