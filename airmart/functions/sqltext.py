"""SQL text of the expressions, for callers that name their columns.

Building a Column through the Python API costs one JVM round trip per node
(tens of milliseconds for a lambda-based expression); the same expression as
SQL text is parsed in one call. The functions in this package use this text
when every argument is a column name, and the Column API otherwise; the SQL
functions of ``plans.catalog`` use it too. Both forms are tested against each
other.
"""

from __future__ import annotations

from .metrics import AQI_BANDS, AQI_BAND_ABOVE, DEFRA_BANDS, EPA_CATEGORIES, POLLUTANT_LABELS, UNKNOWN
from .names import LOWERCASE_WORDS


def q(name: str) -> str:
    """Quote a (possibly qualified) column name: ``f.pm2_5`` -> ```f`.`pm2_5```."""
    return ".".join(f"`{p}`" for p in name.split("."))


def format_name(x: str) -> str:
    words = ", ".join(f"'{w}'" for w in LOWERCASE_WORDS)
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_join(transform(filter(split(replace({x}, '_', ' '), "
            f"'(?U)\\\\s+'), w -> w <> ''), (w, i) -> CASE WHEN i = 0 OR NOT array_contains(array({words}), lower(w)) "
            f"THEN concat(upper(substr(w, 1, 1)), lower(substr(w, 2))) ELSE lower(w) END), ' ') END")


def _args(p, arg_scale):
    if arg_scale is None:
        return list(p)
    return [f"CAST({x} AS DECIMAL(38,{arg_scale}))" for x in p]


def prominent(p, arg_scale=None) -> str:
    z = [f"coalesce({x}, 0)" for x in _args(p, arg_scale)]
    top = f"greatest({', '.join(z)})"
    return "CASE " + " ".join(f"WHEN {zz} = {top} THEN '{lab}'" for zz, lab in zip(z, POLLUTANT_LABELS)) + " END"


def criteria(p, arg_scale=None) -> str:
    a = _args(p, arg_scale)
    pos = " + ".join(f"(CASE WHEN {x} > 0 THEN 1 ELSE 0 END)" for x in a[2:])
    return (f"CAST((CASE WHEN coalesce({a[0]} > 0, false) OR coalesce({a[1]} > 0, false) THEN 1 ELSE 0 END) "
            f"+ least(2, {pos}) AS INT)")


def custom_aqi(p, arg_scale=None) -> str:
    a = _args(p, arg_scale)
    top = f"greatest({', '.join(f'coalesce({x}, 0)' for x in a)})"
    return f"CAST(CASE WHEN {criteria(p, arg_scale)} >= 3 THEN {top} ELSE 0 END AS DECIMAL(10,2))"


def valid(p, arg_scale=None) -> str:
    return (f"CASE WHEN {p[0]} IS NULL AND {p[1]} IS NULL THEN false "
            f"WHEN {criteria(p, arg_scale)} >= 3 THEN true ELSE false END")


def epa(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {k} THEN '{n}'" for k, n in EPA_CATEGORIES) + f" ELSE '{UNKNOWN}' END"


def defra(x: str) -> str:
    return ("CASE " + " ".join(f"WHEN {x} BETWEEN {lo} AND {hi} THEN '{n}'" for lo, hi, n in DEFRA_BANDS)
            + f" ELSE '{UNKNOWN}' END")


def band(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL " + " ".join(f"WHEN {x} <= {hi} THEN '{n}'" for hi, n in AQI_BANDS)
            + f" ELSE '{AQI_BAND_ABOVE}' END")


def round_avg(x: str, digits: int) -> str:
    return f"round(sum({x}) / CAST(nullif(count({x}), 0) AS DECIMAL(20,0)), {digits})"
