"""Batch build of the mart and materialization of its layers (S-9).

Layers are written as parquet tables under the shared folder named by
``spark.checkpoint.dir`` and read back, which cuts lineage (a lost executor
costs a re-read of the table, not a recompute from the landing files) and
gives the serving queries the small plans the reference gets from its
incrementally maintained tables.

Layout (each a folder under the build root):

* ``raw_aqi``            landing table, VARIANT payload (unpartitioned here;
                          landing files themselves are partitioned by path)
* ``clean_aqi``          deduplicated readings, partitioned by ``utc_date`` of
                          the measurement
* ``aqi_consumption``    hourly layer, partitioned by ``utc_date``
* ``air_quality_fact``   partitioned by ``utc_date``
* ``date_dim``, ``location_dim``   small, unpartitioned

A location-hour lies in exactly one UTC date, so ``utc_date`` partitions can
be recomputed independently (``streaming.incremental``). Writes use the
``rebalance`` hint on the partition column: AQE then sizes the output tasks
(splitting a hot date, merging small ones) instead of writing one file per
shuffle task per date. The fact is a narrow projection of the hourly table and
is read from that table's date folders, so it is written without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import CLEAN_COLUMNS, clean
from ..operators.consumption import CONSUMPTION_COLUMNS, build_consumption
from ..operators.star import FACT_COLUMNS, Star, air_quality_fact, date_dim, location_dim

UTC_DATE = "utc_date"


def with_utc_date(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn(UTC_DATE, F.to_date(F.col(ts_col)))


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite",
                rebalance: bool = True) -> None:
    """Write ``df`` as parquet; a partitioned table is rebalanced unless its rows already lie together."""
    if partition_by:
        df = df.hint("rebalance", partition_by) if rebalance else df
        df.write.mode(mode).partitionBy(partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


@dataclass
class Warehouse:
    """Handles on the materialized layers of one build."""

    spark: SparkSession
    root: str
    _tables: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        """The table, read once per handle: schema inference (a Spark job per read) and file
        listing are paid on first use only. A build's tables are immutable; an incremental
        mart hands out a fresh handle after each refresh."""
        df = self._tables.get(name)
        if df is None:
            df = self._tables[name] = self.spark.read.parquet(f"{self.root}/{name}")
        return df

    @property
    def raw(self) -> DataFrame:
        return self.table("raw_aqi")

    @property
    def clean(self) -> DataFrame:
        return self.table("clean_aqi").select(*CLEAN_COLUMNS)

    @property
    def consumption(self) -> DataFrame:
        return self.table("aqi_consumption").select(*CONSUMPTION_COLUMNS)

    @property
    def star(self) -> Star:
        # utc_date (the partition column) stays on the fact so date-bounded pages can prune partitions.
        return Star(self.table("air_quality_fact").select(*FACT_COLUMNS, UTC_DATE), self.table("date_dim"),
                    self.table("location_dim"))


def build_star_tables(spark: SparkSession, cons: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Write fact (by utc_date) and both dimensions from a materialized consumption table."""
    write_table(with_utc_date(air_quality_fact(cons), "utc_timestamp"), f"{root}/air_quality_fact",
                partition_by=UTC_DATE, mode=mode, rebalance=False)
    write_table(date_dim(cons), f"{root}/date_dim")
    write_table(location_dim(cons), f"{root}/location_dim")


def build_warehouse(spark: SparkSession, raw: DataFrame, root: str, arg_scale: int | None = None) -> Warehouse:
    """Landing rows -> raw table -> clean table -> hourly consumption -> star, all materialized."""
    write_table(raw, f"{root}/raw_aqi")
    raw_t = spark.read.parquet(f"{root}/raw_aqi")
    write_table(with_utc_date(clean(raw_t), "measurement_ts"), f"{root}/clean_aqi", partition_by=UTC_DATE)
    clean_t = spark.read.parquet(f"{root}/clean_aqi").select(*CLEAN_COLUMNS)
    cons = build_consumption(clean_t, arg_scale=arg_scale)
    write_table(with_utc_date(cons, "aqi_timestamp_utc"), f"{root}/aqi_consumption", partition_by=UTC_DATE)
    cons_t = spark.read.parquet(f"{root}/aqi_consumption").select(*CONSUMPTION_COLUMNS)
    build_star_tables(spark, cons_t, root)
    return Warehouse(spark, root)


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Handles on an existing build."""
    return Warehouse(spark, root)
