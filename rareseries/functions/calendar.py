"""Date parsing and granularity lookups as Column expressions."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import GRANULARITY_ALIASES, SEASONAL_PERIOD

# Accepted date layouts, tried in order; one pattern takes padded and unpadded
# fields alike. Anything else parses to NULL.
DATE_PATTERNS = (
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d",
    "yyyy/M/d H:m:s",
    "yyyy/M/d H:m",
    "yyyy/M/d",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_dates(col) -> Column:
    """String -> naive timestamp; unparseable or NULL -> NULL (never an error)."""
    s = F.trim(_c(col).cast("string"))
    parsed = [F.try_to_timestamp(s, F.lit(p)) for p in DATE_PATTERNS]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def epoch_micros(col, naive: bool = True) -> Column:
    """Microseconds since 1970-01-01 00:00:00.

    For a naive timestamp this is wall-clock arithmetic (no session time zone
    involved); an instant uses ``unix_micros``.
    """
    c = _c(col)
    if naive:
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c)


def _lookup(col: Column, table: dict, default: Column) -> Column:
    items = list(table.items())
    first, *rest = items
    expr = F.when(col == F.lit(first[0]), F.lit(first[1]))
    expr = reduce(lambda e, kv: e.when(col == F.lit(kv[0]), F.lit(kv[1])), rest, expr)
    return expr.otherwise(default)


def normalize_granularity(col) -> Column:
    """Collapse spelling variants (exact match only); other values pass through."""
    c = _c(col)
    return _lookup(c, GRANULARITY_ALIASES, c)


def seasonal_period(col) -> Column:
    """Seasonal period of a canonical granularity, NULL when unknown."""
    return _lookup(_c(col), SEASONAL_PERIOD, F.lit(None)).cast("long")
