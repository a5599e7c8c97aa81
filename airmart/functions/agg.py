"""Aggregate helpers with exact HALF_UP rounding and deterministic MODE.

``round(avg(decimal(10,2)), 2)`` in Spark rounds twice: ``avg`` keeps only
four extra digits (``decimal(14,6)``), then ``round`` rounds again. For groups
of more than a few thousand rows the first rounding can move a value onto a
half and flip the second. ``round_avg`` divides the exact decimal sum by the
count at 18+ digits of scale instead, which is exact for any count below
10**15 (the distance of a non-half quotient from the half is at least
1/(2n)). Both are the same partial+final hash aggregate (sum, count).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def round_avg(c, digits: int) -> Column:
    """``ROUND(AVG(c), digits)`` rounded HALF_UP from the exact mean (NULL for no values)."""
    if isinstance(c, str):
        from . import sqltext
        return F.expr(sqltext.round_avg(sqltext.q(c), digits))
    c = as_col(c)
    n = F.nullif(F.count(c), F.lit(0)).cast("decimal(20,0)")
    return F.round(F.sum(c) / n, digits)


def mode_of(c) -> Column:
    """MODE with ties resolved to the smallest value (D7); NULLs ignored."""
    return F.mode(as_col(c), deterministic=True)
