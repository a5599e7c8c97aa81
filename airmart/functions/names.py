"""U-1 ``format_location_name`` as a column expression (no Python worker).

Slug or free text -> title case, with Spanish articles and prepositions kept
lower case unless they are the first word. NULL in, NULL out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values (must equal the reference's list): words that stay lower case
# when they are not the first word.
LOWERCASE_WORDS = ("de", "del", "la", "las", "el", "los", "y", "e", "a", "al")


def _capitalize(w: Column) -> Column:
    return F.concat(F.upper(w.substr(1, 1)), F.lower(w.substr(2, 1 << 30)))


def format_location_name(c) -> Column:
    """``'san_juan_de_lurigancho'`` -> ``'San Juan de Lurigancho'``."""
    if isinstance(c, str):
        from . import sqltext
        return F.expr(sqltext.format_name(sqltext.q(c)))
    c = as_col(c)
    words = F.filter(F.split(F.regexp_replace(c, "_", " "), r"(?U)\s+"), lambda w: w != "")
    shaped = F.transform(
        words,
        lambda w, i: F.when((i == 0) | ~F.lower(w).isin(*LOWERCASE_WORDS), _capitalize(w))
        .otherwise(F.lower(w)),
    )
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.array_join(shaped, " "))
