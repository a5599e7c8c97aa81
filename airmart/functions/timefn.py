"""Time helpers (F-1, F-5, F-6, F-8, F-10, F-14) that do not depend on the session zone.

Readings carry ``TIMESTAMP_NTZ`` values in UTC. Spark's ``date_trunc`` returns
an LTZ timestamp even for NTZ input, so flooring to the hour is written with
``make_timestamp_ntz`` from the wall-clock fields instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_from_epoch(epoch) -> Column:
    """F-1 ``TO_TIMESTAMP(epoch)``: UTC wall clock as TIMESTAMP_NTZ."""
    e = as_col(epoch).cast("bigint")
    return F.timestamp_add("SECOND", e, F.expr(_EPOCH_NTZ))


def hour_floor(ts) -> Column:
    """F-5 ``DATE_TRUNC('HOUR', ntz)`` keeping TIMESTAMP_NTZ."""
    t = as_col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def minute_floor(ts) -> Column:
    t = as_col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.lit(0))


def to_local(ts_utc, tz) -> Column:
    """F-6 ``CONVERT_TIMEZONE(tz, ts)`` with the source taken as UTC (D1): local wall clock."""
    return F.convert_timezone(F.lit("UTC"), as_col(tz), as_col(ts_utc))


def local_hour(ts_utc, tz) -> Column:
    return hour_floor(to_local(ts_utc, tz))


def day_of_week0(ts) -> Column:
    """F-8 ``DAYOFWEEK`` with 0 = Sunday (D16)."""
    return F.dayofweek(as_col(ts)) - 1


def day_name(ts) -> Column:
    """F-8 ``DAYNAME``: three-letter English name (``Sun``)."""
    return F.dayname(as_col(ts))


def boundary_diff(unit: str, start, end) -> Column:
    """F-10 / D15 ``DATEDIFF(unit, a, b)``: unit boundaries crossed, not whole units elapsed."""
    unit = unit.upper()
    floors = {"MINUTE": minute_floor, "HOUR": hour_floor}
    if unit not in floors:
        raise ValueError(f"unsupported unit {unit}")
    s, e = as_col(start).cast("timestamp_ntz"), as_col(end).cast("timestamp_ntz")
    return F.timestamp_diff(unit, floors[unit](s), floors[unit](e))


def hour_label(hour) -> Column:
    """F-14 ``LPAD(h::VARCHAR, 2, '0') || ':00'``."""
    return F.concat(F.lpad(as_col(hour).cast("string"), 2, "0"), F.lit(":00"))
