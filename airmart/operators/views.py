"""Serving views over the star schema (A-4, A-5, A-6, B-7, W-2, W-3).

Every view joins the fact to its dimensions without hints: Spark broadcasts a
dimension by its size, so the fact is read once and, while dimensions are small,
not shuffled for a join; then the only shuffle is the aggregation's, after a
map-side partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.agg import mode_of, round_avg
from .star import Star

POLLUTANT_AVGS = (("pm2_5", "pm25_avg"), ("pm10", "pm10_avg"), ("co", "co_avg"), ("no2", "no2_avg"),
                  ("o3", "o3_avg"), ("so2", "so2_avg"))


def _pollutant_avgs():
    return [round_avg(f"f.{c}", 2).alias(a) for c, a in POLLUTANT_AVGS]


def daily_city_agg_rows(j: DataFrame) -> DataFrame:
    """The A-4 aggregation over already joined ``f``/``l``/``d`` rows."""
    return (j.groupBy(F.col("l.country").alias("country"), F.col("l.city").alias("city"),
                      F.to_date(F.col("f.local_timestamp")).alias("measurement_date"),
                      F.col("d.aqi_year").alias("aqi_year"), F.col("d.aqi_month").alias("aqi_month"),
                      F.col("d.aqi_day_name").alias("aqi_day_name"))
            .agg(*_pollutant_avgs(),
                 mode_of(F.col("f.prominent_pollutant")).alias("prominent_pollutant"),
                 round_avg("f.custom_aqi", 0).alias("aqi"),
                 F.count(F.lit(1)).alias("hourly_readings_in_day"),
                 F.count_distinct(F.col("l.district")).alias("districts_reporting"),
                 F.sum(F.col("f.readings_in_hour")).alias("total_raw_readings")))


def daily_city_agg(star: Star) -> DataFrame:
    """A-4 ``vw_daily_city_agg``: one row per country, city and local day."""
    return daily_city_agg_rows(star.fact_location_date())


def hourly_city_agg(star: Star) -> DataFrame:
    """A-5 ``vw_hourly_city_agg``: one row per country, city and local hour."""
    j = star.fact_location_date()
    return (j.groupBy(F.col("l.country").alias("country"), F.col("l.city").alias("city"),
                      F.col("f.local_timestamp").alias("measurement_time"),
                      F.col("d.aqi_year").alias("aqi_year"), F.col("d.aqi_month").alias("aqi_month"),
                      F.col("d.aqi_day").alias("aqi_day"), F.col("d.aqi_hour").alias("aqi_hour"),
                      F.col("d.aqi_day_name").alias("aqi_day_name"))
            .agg(*_pollutant_avgs(),
                 round_avg("f.temp_c", 1).alias("temp_c_avg"),
                 round_avg("f.humidity", 0).alias("humidity_avg"),
                 round_avg("f.wind_kph", 1).alias("wind_kph_avg"),
                 F.count_distinct(F.col("l.district")).alias("districts_reporting"),
                 F.sum(F.col("f.readings_in_hour")).alias("total_raw_readings")))


def hourly_district_detail(star: Star) -> DataFrame:
    """B-7 ``vw_hourly_district_detail``: the unaggregated three-way join."""
    j = star.fact_location_date()
    f, l, d = (lambda c: F.col(f"f.{c}")), (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"d.{c}"))
    return j.select(
        *[l(c).alias(c) for c in ("country", "city", "district", "location_name", "region", "latitude",
                                  "longitude", "timezone_id")],
        f("local_timestamp").alias("measurement_time"), f("utc_timestamp").alias("measurement_time_utc"),
        *[d(c).alias(c) for c in ("aqi_year", "aqi_month", "aqi_day", "aqi_hour", "aqi_day_name")],
        f("pm2_5").alias("pm25_avg"), f("pm10").alias("pm10_avg"), f("so2").alias("so2_avg"),
        f("no2").alias("no2_avg"), f("co").alias("co_avg"), f("o3").alias("o3_avg"),
        f("us_epa_index").alias("us_epa_index"), f("gb_defra_index").alias("gb_defra_index"),
        f("custom_aqi").alias("aqi"), f("prominent_pollutant").alias("prominent_pollutant"),
        f("criteria_pollutant_count").alias("criteria_pollutant_count"),
        *[f(c).alias(c) for c in ("temp_c", "humidity", "cloud_cover", "wind_kph", "wind_direction",
                                  "pressure_mb", "precip_mm", "visibility_km", "uv_index",
                                  "readings_in_hour", "is_valid_measurement")],
    )


def latest_district_aqi(star: Star) -> DataFrame:
    """W-2 ``vw_latest_district_aqi``: the most recent hour per location key.

    Ties on the local hour (half-hour zones, DST) resolve to the later UTC hour,
    then the smaller district (D8). ``row_number() == 1`` becomes a partial
    WindowGroupLimit before the shuffle, so a hot location is cut map-side.
    """
    j = star.fact_location()
    w = Window.partitionBy(F.col("f.location_fk")).orderBy(
        F.col("f.local_timestamp").desc_nulls_first(), F.col("f.utc_timestamp").desc_nulls_first(),
        F.col("l.district").asc_nulls_last())
    ranked = j.select(
        F.col("f.location_fk").alias("location_fk"),
        *[F.col(f"l.{c}").alias(c) for c in ("country", "city", "district", "location_name", "latitude",
                                             "longitude", "timezone_id")],
        F.col("f.local_timestamp").alias("latest_reading_time"),
        F.col("f.utc_timestamp").alias("latest_reading_time_utc"),
        F.col("f.pm2_5").alias("pm2_5"), F.col("f.pm10").alias("pm10"), F.col("f.custom_aqi").alias("aqi"),
        F.col("f.prominent_pollutant").alias("prominent_pollutant"),
        F.col("f.us_epa_index").alias("us_epa_index"), F.col("f.gb_defra_index").alias("gb_defra_index"),
        F.row_number().over(w).alias("_recency_rank"))
    return ranked.where(F.col("_recency_rank") == 1).drop("_recency_rank", "location_fk")


def daily_district_aqi(star: Star) -> DataFrame:
    """A-6 ``vw_daily_district_aqi``: one row per location and local day."""
    j = star.fact_location()
    return (j.groupBy(*[F.col(f"l.{c}").alias(c) for c in ("country", "city", "district", "location_name",
                                                           "latitude", "longitude", "timezone_id")],
                      F.to_date(F.col("f.local_timestamp")).alias("measurement_date"))
            .agg(*_pollutant_avgs(),
                 round_avg("f.custom_aqi", 0).alias("aqi"),
                 mode_of(F.col("f.prominent_pollutant")).alias("prominent_pollutant"),
                 F.count(F.lit(1)).alias("hourly_readings_in_day"),
                 F.sum(F.col("f.readings_in_hour")).alias("total_raw_readings")))


def location_hierarchy(star: Star) -> DataFrame:
    """W-3 ``vw_location_hierarchy``: each location with its days of data and latest hour.

    ``COUNT(DISTINCT ..) OVER`` is not a Spark window, and it is the same value
    per key as an aggregate: facts are aggregated per ``location_fk`` first
    (partial aggregate, no fan-out) and left-joined to the dimension. The
    reference's ``SELECT DISTINCT`` needs no shuffle here: dimension rows are
    distinct and the statistics hold one row per key, so joined rows are too.
    """
    stats = (star.fact.groupBy("location_fk")
             .agg(F.count_distinct(F.to_date("local_timestamp")).alias("days_with_data"),
                  F.max("local_timestamp").alias("latest_reading_time")))
    loc = star.location_dim
    j = loc.join(stats, loc.location_pk == stats.location_fk, "left")
    return (j.select("country", "city", "district", "location_name", "region", "timezone_id", "latitude",
                     "longitude", F.coalesce(F.col("days_with_data"), F.lit(0)).alias("days_with_data"),
                     "latest_reading_time")
            .orderBy(F.col("country").asc_nulls_last(), F.col("city").asc_nulls_last(),
                     F.col("district").asc_nulls_last()))
