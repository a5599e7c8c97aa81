"""Written tables that cut lineage, and small schema helpers shared by the operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_table_root

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LAST_ID = (1 << 63) - 1  # a null id orders after every other id


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    The written table replaces the lineage, so a lost executor costs a re-read and not a recomputation;
    the shuffle files that produced it are of no further use and are dropped when the write ends.
    """
    spark = df.sparkSession
    path = new_table_root(spark, f"llm-{label}")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is written meanwhile passes rows to Python in batches of about ``size`` bytes (a row is never split)."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, size)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """The session's shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def order_id(column: str) -> Column:
    """An id as a long that orders nulls last. The largest long stands for null, so a row with that very id counts as
    one without an id."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def own_id(column: str) -> Column:
    """The inverse of ``order_id``."""
    return F.nullif(F.col(column), F.lit(LAST_ID))


_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
          "boolean": T.BooleanType(), "binary": T.BinaryType(), "longs": T.ArrayType(T.LongType())}


def schema(fields: str, *head: T.StructField) -> T.StructType:
    """``"a long, b string"`` as a struct type (no session needed), after the fields in ``head``."""
    return T.StructType([*head, *(T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in fields.split(",")))])
