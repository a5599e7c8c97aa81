"""F-13 surrogate keys.

``xxhash64(NULL, 5) = xxhash64(5, NULL)`` in Spark, so every argument is
preceded by its null flag. ``xxhash64`` also depends on the decimal scale, so
callers pass columns of fixed types (lat/lon DECIMAL(10,7), TIMESTAMP_NTZ).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def surrogate_key(*cols) -> Column:
    parts = []
    for c in cols:
        c = as_col(c)
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)
