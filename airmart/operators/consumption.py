"""Consumption layer: hourly roll-up (A-1), time hierarchy + derived metrics (A-2),
daily view (A-3) and current status per district (B-9).

A-1 is one hash aggregate (partial on the map side, final after one shuffle on
the ten group keys); MODE is an ObjectHashAggregate whose buffer is bounded by
the handful of distinct wind directions / conditions, so the session settings
allow more groups per task before it falls back to sorting. Location names are
formatted *after* grouping (D10), once per group instead of once per reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.agg import mode_of, round_avg
from ..functions.metrics import (aqi_criteria_met, custom_aqi, defra_category, epa_category,
                                 is_valid_measurement, prominent_pollutant)
from ..functions.names import format_location_name
from ..functions.timefn import day_name, day_of_week0, hour_floor, local_hour

GROUP_KEYS = ("country", "city", "district", "location_name", "region", "latitude", "longitude", "timezone_id")

# (column, digits, output type) of the hourly averages.
HOURLY_AVERAGES = (
    ("pm2_5", 2, "decimal(10,2)"), ("pm10", 2, "decimal(10,2)"), ("so2", 2, "decimal(10,2)"),
    ("no2", 2, "decimal(10,2)"), ("co", 2, "decimal(10,2)"), ("o3", 2, "decimal(10,2)"),
    ("us_epa_index", 0, "decimal(10,0)"), ("gb_defra_index", 0, "decimal(10,0)"),
    ("temp_c", 1, "decimal(10,1)"), ("humidity", 0, "decimal(10,0)"), ("cloud_cover", 0, "decimal(10,0)"),
    ("wind_kph", 1, "decimal(10,1)"),
    ("pressure_mb", 1, "decimal(10,1)"), ("precip_mm", 2, "decimal(10,2)"),
    ("visibility_km", 1, "decimal(10,1)"), ("uv_index", 0, "decimal(10,0)"),
)
POLLUTANTS = ("pm2_5", "pm10", "so2", "no2", "co", "o3")

CONSUMPTION_COLUMNS = (
    "aqi_timestamp", "aqi_year", "aqi_month", "aqi_quarter", "aqi_day", "aqi_hour", "aqi_day_of_week",
    "aqi_day_name", "aqi_timestamp_utc", "country", "city", "district", "location_name", "region",
    "latitude", "longitude", "timezone_id", "pm2_5", "pm10", "so2", "no2", "co", "o3", "us_epa_index",
    "gb_defra_index", "temp_c", "humidity", "cloud_cover", "wind_kph", "wind_direction", "pressure_mb",
    "precip_mm", "visibility_km", "uv_index", "weather_condition", "prominent_pollutant",
    "criteria_pollutant_count", "custom_aqi", "epa_category", "defra_category", "is_valid_measurement",
    "readings_in_hour", "_stg_file_load_ts", "_copy_data_ts",
)


def hourly_rollup(clean: DataFrame) -> DataFrame:
    """A-1: one row per (local hour, UTC hour, location); averages of the readings in the hour.

    Both the local and the UTC hour are group keys (D2): in a half-hour zone,
    or across a DST fall-back, one local hour yields two rows.
    """
    avg_cols = [round_avg(c, d).cast(t).alias(c) for c, d, t in HOURLY_AVERAGES]
    agg = (clean
           .groupBy(local_hour("measurement_ts", "timezone_id").alias("hour_timestamp_local"),
                    hour_floor("measurement_ts").alias("hour_timestamp_utc"),
                    *GROUP_KEYS)
           .agg(*avg_cols,
                mode_of("wind_direction").alias("wind_direction"),
                mode_of("weather_condition").alias("weather_condition"),
                F.max("_stg_file_load_ts").alias("_stg_file_load_ts"),
                F.max("_copy_data_ts").alias("_copy_data_ts"),
                F.count(F.lit(1)).alias("readings_in_hour")))
    return agg.select(
        "hour_timestamp_local", "hour_timestamp_utc",
        *[format_location_name(c).alias(c) for c in ("country", "city", "district")],
        *[c for c in agg.columns if c not in ("hour_timestamp_local", "hour_timestamp_utc",
                                              "country", "city", "district")])


def consumption(hourly: DataFrame, arg_scale: int | None = None) -> DataFrame:
    """A-2: ``aqi_consumption_dt`` - time hierarchy in local time plus derived metrics."""
    t = F.col("hour_timestamp_local")
    p = list(POLLUTANTS)
    criteria = aqi_criteria_met(*p, arg_scale=arg_scale)
    return hourly.select(
        t.alias("aqi_timestamp"),
        F.year(t).alias("aqi_year"), F.month(t).alias("aqi_month"), F.quarter(t).alias("aqi_quarter"),
        F.dayofmonth(t).alias("aqi_day"), F.hour(t).alias("aqi_hour"),
        day_of_week0(t).alias("aqi_day_of_week"), day_name(t).alias("aqi_day_name"),
        F.col("hour_timestamp_utc").alias("aqi_timestamp_utc"),
        *GROUP_KEYS, *POLLUTANTS, "us_epa_index", "gb_defra_index",
        "temp_c", "humidity", "cloud_cover", "wind_kph", "wind_direction", "pressure_mb",
        "precip_mm", "visibility_km", "uv_index", "weather_condition",
        prominent_pollutant(*p, arg_scale=arg_scale).alias("prominent_pollutant"),
        criteria.alias("criteria_pollutant_count"),
        custom_aqi(*p, arg_scale=arg_scale).alias("custom_aqi"),
        epa_category("us_epa_index").alias("epa_category"),
        defra_category("gb_defra_index").alias("defra_category"),
        is_valid_measurement(*p, arg_scale=arg_scale).alias("is_valid_measurement"),
        "readings_in_hour", "_stg_file_load_ts", "_copy_data_ts",
    )


def build_consumption(clean: DataFrame, arg_scale: int | None = None) -> DataFrame:
    return consumption(hourly_rollup(clean), arg_scale=arg_scale)


def time_hierarchy(cons: DataFrame) -> DataFrame:
    """The local/UTC time columns of the consumption layer with their location."""
    return cons.select("aqi_timestamp", "aqi_year", "aqi_month", "aqi_quarter", "aqi_day", "aqi_hour",
                       "aqi_day_of_week", "aqi_day_name", "aqi_timestamp_utc", "location_name",
                       "latitude", "longitude", "timezone_id")


def aqi_daily(cons: DataFrame) -> DataFrame:
    """A-3 ``vw_aqi_daily``: one row per location and local day."""
    return (cons
            .groupBy("country", "district", "location_name", "aqi_year", "aqi_month", "aqi_day",
                     F.to_date("aqi_timestamp").alias("measurement_date"))
            .agg(round_avg("pm2_5", 2).alias("daily_avg_pm2_5"),
                 round_avg("pm10", 2).alias("daily_avg_pm10"),
                 round_avg("us_epa_index", 2).alias("daily_avg_epa_index"),
                 F.max("us_epa_index").alias("daily_max_epa_index"),
                 mode_of("epa_category").alias("predominant_category"),
                 round_avg("temp_c", 1).alias("daily_avg_temp_c"),
                 F.count(F.lit(1)).alias("hourly_measurements"),
                 F.sum("readings_in_hour").alias("total_raw_readings")))


def aqi_current(cons: DataFrame) -> DataFrame:
    """B-9 ``vw_aqi_current``: rows at the latest hour of each (country, district).

    Rows with a NULL country or district drop out, and every location sharing
    the latest hour is returned (D18): rank 1 over (country, district) by hour,
    which Spark limits within each map task before the shuffle, so a district
    that holds a third of all rows sends only its latest rows.
    """
    latest_first = Window.partitionBy("country", "district").orderBy(F.col("aqi_timestamp").desc())
    return (cons.where(F.col("country").isNotNull() & F.col("district").isNotNull() & F.col("aqi_timestamp").isNotNull())
            .select("country", "district", "location_name", F.col("aqi_timestamp").alias("last_updated"),
                    "latitude", "longitude", "timezone_id", "pm2_5", "pm10", "us_epa_index", "epa_category",
                    "prominent_pollutant", "temp_c", "humidity", "wind_kph", "weather_condition", "is_valid_measurement",
                    "readings_in_hour", F.rank().over(latest_first).alias("_rank"))
            .where(F.col("_rank") == 1).drop("_rank"))
