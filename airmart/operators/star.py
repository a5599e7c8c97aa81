"""Star schema over the consumption layer (A-10, P-3).

``date_dim`` and ``location_dim`` are ``distinct`` projections (partial
distinct on the map side, so the shuffle carries at most one row per key per
task); the fact is a narrow projection with hash keys and needs no shuffle.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key

DATE_COLUMNS = ("aqi_year", "aqi_month", "aqi_quarter", "aqi_day", "aqi_hour", "aqi_day_of_week", "aqi_day_name")
LOCATION_COLUMNS = ("latitude", "longitude", "country", "city", "district", "location_name", "region",
                    "timezone_id")

FACT_COLUMNS = (
    "aqi_pk", "date_fk", "location_fk", "local_timestamp", "utc_timestamp", "aqi_hour", "aqi_day_of_week",
    "aqi_day_name", "pm2_5", "pm10", "so2", "no2", "co", "o3", "us_epa_index", "gb_defra_index",
    "prominent_pollutant", "criteria_pollutant_count", "custom_aqi", "temp_c", "humidity", "cloud_cover",
    "wind_kph", "wind_direction", "pressure_mb", "precip_mm", "visibility_km", "uv_index",
    "is_valid_measurement", "readings_in_hour", "_stg_file_load_ts", "_copy_data_ts",
)


def date_key(ts) -> F.Column:
    return surrogate_key(ts)


def location_key(lat, lon) -> F.Column:
    return surrogate_key(lat, lon)


def date_dim(cons: DataFrame, extra: tuple = ()) -> DataFrame:
    """One row per distinct local hour and its calendar attributes; key = hash(local_timestamp).

    ``extra`` columns join the distinct (the incremental refresh keeps one part per UTC date).
    """
    d = cons.select(F.col("aqi_timestamp").alias("local_timestamp"), *DATE_COLUMNS, *extra).distinct()
    return d.select(date_key("local_timestamp").alias("date_pk"), "local_timestamp", *DATE_COLUMNS, *extra)


def location_dim(cons: DataFrame, extra: tuple = ()) -> DataFrame:
    """One row per distinct 8-column location; key = hash(lat, lon), so shared coordinates collide (D6)."""
    d = cons.select(*LOCATION_COLUMNS, *extra).distinct()
    return d.select(location_key("latitude", "longitude").alias("location_pk"), *LOCATION_COLUMNS, *extra)


def air_quality_fact(cons: DataFrame) -> DataFrame:
    """Hourly facts with keys and denormalized time columns."""
    return cons.select(
        surrogate_key("aqi_timestamp", "latitude", "longitude").alias("aqi_pk"),
        date_key("aqi_timestamp").alias("date_fk"),
        location_key("latitude", "longitude").alias("location_fk"),
        F.col("aqi_timestamp").alias("local_timestamp"),
        F.col("aqi_timestamp_utc").alias("utc_timestamp"),
        *FACT_COLUMNS[5:],
    )


@dataclass
class Star:
    """The three star tables. Joins carry no hints: Spark broadcasts a dimension by its size in bytes, or
    adaptively by its size at run time, and sorts and merges beyond that."""

    fact: DataFrame
    date_dim: DataFrame
    location_dim: DataFrame

    def for_local_dates(self, first, last=None) -> "Star":
        """Facts of local days ``first..last`` only, pruned to the UTC-date partitions that can hold them.

        Zone offsets lie within -12h..+14h, so a local day's hours fall in UTC
        dates day-1..day+1; when the fact carries its ``utc_date`` partition
        column that range becomes a partition filter (only three date folders
        are listed and read per day), and the exact local-day predicate is
        applied on top.
        """
        first = _as_date(first)
        last = _as_date(last) if last is not None else first
        f = self.fact
        if "utc_date" in f.columns:
            f = f.where(F.col("utc_date").between(F.date_sub(F.lit(first), 1), F.date_add(F.lit(last), 1)))
        f = f.where(F.to_date(F.col("local_timestamp")).between(F.lit(first), F.lit(last)))
        return Star(f, self.date_dim, self.location_dim)

    def latest_utc_dates(self, days: int) -> "Star":
        """Facts of the ``days`` latest UTC dates only.

        The latest date comes from the partition column, and as a scalar
        subquery on it the filter prunes date folders at run time. A fact
        without the partition column is left as it is.
        """
        if "utc_date" not in self.fact.columns:
            return self
        last = self.fact.agg(F.max("utc_date")).scalar()
        return Star(self.fact.where(F.col("utc_date") > F.date_sub(last, days)), self.date_dim, self.location_dim)

    def fact_location(self) -> DataFrame:
        """``fact f JOIN location_dim l ON f.location_fk = l.location_pk`` (J-1)."""
        f, loc = self.fact.alias("f"), self.location_dim.alias("l")
        return f.join(loc, F.col("f.location_fk") == F.col("l.location_pk"))

    def fact_location_date(self) -> DataFrame:
        """J-1 plus ``JOIN date_dim d ON f.date_fk = d.date_pk`` (J-2)."""
        d = self.date_dim.alias("d")
        return self.fact_location().join(d, F.col("f.date_fk") == F.col("d.date_pk"))


def _as_date(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def star_from_consumption(cons: DataFrame) -> Star:
    return Star(air_quality_fact(cons), date_dim(cons), location_dim(cons))
