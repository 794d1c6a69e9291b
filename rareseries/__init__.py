"""Spark library for finding and cataloguing time series with a rare regime."""
import sys

from .params import DEFAULT, ScoreParams

# Python functions that run inside Spark tasks (the streaming hash) are pickled
# by value, so executors need no copy of this package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler without the hook
    pass

__all__ = ["DEFAULT", "ScoreParams"]
