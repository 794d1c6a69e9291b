"""Relevance, severity band and license as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import (LEVEL_BANDS, LEVEL_NONE, LEVEL_TOP, LICENSE_DEFAULT, LICENSE_UNKNOWN,
                      LICENSE_UNKNOWN_SOURCE, LICENSE_UNLICENSED, LICENSE_UNLICENSED_PREFIX)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def imbalance_level(n_rare, pct_rare) -> Column:
    """none when nothing is rare, else the first band whose bound exceeds %Rare."""
    n, p = _c(n_rare), _c(pct_rare)
    expr = F.when(n.isNull(), F.lit(None)).when(n == 0, F.lit(LEVEL_NONE))
    for name, bound in LEVEL_BANDS:
        expr = expr.when(p < F.lit(bound), F.lit(name))
    return expr.otherwise(F.lit(LEVEL_TOP))


def license_of(source, collection) -> Column:
    s, c = _c(source), _c(collection)
    return (F.when(s == F.lit(LICENSE_UNKNOWN_SOURCE), F.lit(LICENSE_UNKNOWN))
             .when(c.cast("string").startswith(LICENSE_UNLICENSED_PREFIX), F.lit(LICENSE_UNLICENSED))
             .otherwise(F.lit(LICENSE_DEFAULT)))


def _smooth(t: Column) -> Column:
    """Cubic Hermite step between control points (0, 0) and (1, 1) with zero slopes."""
    return F.lit(3.0) * t * t - F.lit(2.0) * t * t * t


def relevance(y, median, hi_adj, lo_adj, hi_on, lo_on) -> Column:
    """phi(y) in [0, 1] from the boxplot control points.

    Control points: (median, 0); on an active side (there are outliers beyond
    that fence) the adjacent value gets relevance 1, all slopes are 0 and the
    curve is constant outside. A side whose adjacent value equals the median
    gives 1 to every value beyond the median on that side.
    """
    y, m, hw, lw = _c(y), _c(median), _c(hi_adj), _c(lo_adj)
    hi_on, lo_on = _c(hi_on), _c(lo_on)
    t_hi = F.least(F.greatest(F.try_divide(y - m, hw - m), F.lit(0.0)), F.lit(1.0))
    t_lo = F.least(F.greatest(F.try_divide(m - y, m - lw), F.lit(0.0)), F.lit(1.0))
    high = F.when(hw > m, _smooth(t_hi)).otherwise(F.lit(1.0))
    low = F.when(lw < m, _smooth(t_lo)).otherwise(F.lit(1.0))
    return (F.when(hi_on & (y > m), high)
             .when(lo_on & (y < m), low)
             .otherwise(F.lit(0.0)))
