"""What several test modules share."""
from __future__ import annotations

import math

SF_SMALL = "/root/testdata/sf0.001"


def close(a, b, tol=1e-9) -> bool:
    """Equal within tolerance; NULL/NaN equal each other; inf equals inf."""
    na = a is None or (isinstance(a, float) and math.isnan(a))
    nb = b is None or (isinstance(b, float) and math.isnan(b))
    if na or nb:
        return na and nb
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return a == b
