"""Dashboard queries (B-1..B-5, B-8, A-7..A-9, P-4, P-9, P-10).

The reference's pages build SQL text by string interpolation and post-process
results in pandas. Here every page query is a DataFrame with bound literal
filters; nothing is collected by the library. A filter that is not given
selects everything and its column is kept in the output, so the same function
serves the cascading drill-down and the whole-table report.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.agg import round_avg
from ..functions.metrics import aqi_band, freshness_status
from ..functions.timefn import boundary_diff, hour_label
from .star import Star
from .views import (daily_city_agg_rows, daily_district_aqi, hourly_city_agg, hourly_district_detail,
                    latest_district_aqi)

POLLUTANT_COLUMNS = {"PM2.5": "pm25_avg", "PM10": "pm10_avg", "SO2": "so2_avg", "NO2": "no2_avg",
                     "CO": "co_avg", "O3": "o3_avg"}
SERIES_POLLUTANTS = ("pm25_avg", "pm10_avg", "so2_avg", "no2_avg", "co_avg", "o3_avg")
HIERARCHY = ("country", "city", "district")


def _date_expr(df: DataFrame) -> Column:
    if "measurement_date" in df.columns:
        return F.col("measurement_date")
    return F.to_date(F.col("measurement_time"))


def filters(df: DataFrame, **eq) -> DataFrame:
    """P-4: equality filters with bound literals; ``date`` compares the local day."""
    cond = F.lit(True)
    for k, v in eq.items():
        if v is None:
            continue
        if k == "date":
            cond = cond & (_date_expr(df) == F.lit(_as_date(v)))
        else:
            cond = cond & (F.col(k) == F.lit(v))
    return df.where(cond)


def _as_date(v):
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v


def filter_values(view: DataFrame, level: str, **parents) -> DataFrame:
    """B-2 cascading selector values: distinct ``level`` under the given parents.

    ``level`` is one of country, city, district, measurement_date. Parents not
    given stay as output columns (so the whole-table form lists every path).
    Dates sort newest first, names ascending.
    """
    chain = [c for c in HIERARCHY if c in view.columns] + ["measurement_date"]
    upto = chain[: chain.index(level)]
    fixed = {k: v for k, v in parents.items() if v is not None}
    df = filters(view, **fixed)
    if level == "measurement_date" and "measurement_date" not in view.columns:
        df = df.withColumn("measurement_date", F.to_date("measurement_time"))
    keep = [c for c in upto if c not in fixed and c != "date"] + [level]
    order = [F.col(c).asc_nulls_last() for c in keep[:-1]]
    order.append(F.col(level).desc_nulls_first() if level == "measurement_date" else F.col(level).asc_nulls_last())
    return df.select(*keep).distinct().orderBy(*order)


def latest_local_day(star: Star) -> DataFrame:
    """One row: the latest local day with facts.

    Read from the fact alone: every fact joins both dimensions (they are
    distinct projections of the same hourly table, which ``key_integrity``
    checks), so the day equals ``MAX(measurement_date)`` of the joined view
    without re-joining the dimensions. A local day is at most one day off its
    UTC date, so it lies in the three latest UTC dates, and only these are read.
    """
    return star.latest_utc_dates(3).fact.agg(F.max(F.to_date("local_timestamp")).alias("_latest_day"))


def top_cities(star: Star, n: int = 10) -> DataFrame:
    """B-1: the ``n`` cities with the highest AQI on the latest local day.

    The latest day is a one-row aggregate (broadcast, bounded by construction);
    facts are pruned to the three latest UTC dates, which hold it, and filtered to
    that day *before* the daily aggregation, so only one day's rows reach the
    shuffle. Ties order by country, city (D20).
    """
    j = star.latest_utc_dates(3).fact_location_date()
    day = j.join(F.broadcast(latest_local_day(star)),
                 F.to_date(F.col("f.local_timestamp")) == F.col("_latest_day"))
    agg = daily_city_agg_rows(day)
    return (agg.select("country", "city", "pm25_avg", "pm10_avg", "so2_avg", "no2_avg", "co_avg", "o3_avg",
                       "prominent_pollutant", "aqi")
            .orderBy(F.col("aqi").desc_nulls_first(), F.col("country").asc_nulls_last(),
                     F.col("city").asc_nulls_last())
            .limit(n))


def city_hourly_series(hourly_city: DataFrame, country=None, city=None, date=None,
                       pollutant: str | None = None) -> DataFrame:
    """B-3: hourly series of a city-day with ``HH:00`` labels, ordered by hour."""
    df = filters(hourly_city, country=country, city=city, date=date)
    keys = [c for c, v in (("country", country), ("city", city)) if v is None]
    if date is None:
        keys.append(F.to_date("measurement_time").alias("measurement_date"))
    values = [POLLUTANT_COLUMNS[pollutant]] if pollutant else list(SERIES_POLLUTANTS)
    return (df.select(*keys, hour_label("aqi_hour").alias("hour"), "aqi_hour", *values)
            .orderBy(*[F.col(k if isinstance(k, str) else "measurement_date") for k in keys], "aqi_hour")
            .drop("aqi_hour"))


def district_hourly_series(detail: DataFrame, country=None, city=None, district=None, date=None,
                           pollutant: str | None = None) -> DataFrame:
    """B-4: hourly district series with AQI, prominent pollutant and coordinates."""
    df = filters(detail, country=country, city=city, district=district, date=date)
    extra = [] if date is not None else [F.to_date("measurement_time").alias("measurement_date"),
                                         F.col("measurement_time")]
    values = [POLLUTANT_COLUMNS[pollutant]] if pollutant else list(SERIES_POLLUTANTS)
    out = df.select(hour_label("aqi_hour").alias("hour"), "country", "city", "district", "latitude",
                    "longitude", *values, "prominent_pollutant", "aqi", *extra, "aqi_hour")
    order = ["country", "city", "district"] + (["measurement_time"] if date is None else []) + ["aqi_hour"]
    cols = [c for c in out.columns if c not in ("aqi_hour", "measurement_time")]
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in order]).select(*cols)


def _map_base(daily_district: DataFrame, country, city, date):
    df = filters(daily_district, country=country, city=city, date=date)
    df = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    keys = [c for c, v in (("country", country), ("city", city), ("measurement_date", date)) if v is None]
    return df, keys


def map_rows(daily_district: DataFrame, country=None, city=None, date=None) -> DataFrame:
    """B-5: district rows of a city-day with coordinates (P-5), AQI descending."""
    df, keys = _map_base(daily_district, country, city, date)
    return (df.select(*keys, "district", "location_name", "latitude", "longitude", "aqi", "pm25_avg",
                      "pm10_avg", "prominent_pollutant", "hourly_readings_in_day")
            .orderBy(F.col("aqi").desc_nulls_first(), F.col("district").asc_nulls_last()))


def map_summary(daily_district: DataFrame, country=None, city=None, date=None) -> DataFrame:
    """A-9: district count, mean / max / min AQI and the districts holding max and min.

    One row per (country, city, day) left open by the filters. Ties for the
    extremes resolve to the smallest district name.
    """
    df, keys = _map_base(daily_district, country, city, date)
    has = F.col("aqi").isNotNull()
    worst = F.min_by(F.col("district"), F.when(has, F.struct((-F.col("aqi")).alias("a"), F.col("district").alias("d"))))
    best = F.min_by(F.col("district"), F.when(has, F.struct(F.col("aqi").alias("a"), F.col("district").alias("d"))))
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("districts"),
                 round_avg("aqi", 0).alias("avg_aqi"),
                 F.max("aqi").alias("max_aqi"),
                 F.min("aqi").alias("min_aqi"),
                 worst.alias("worst_district"),
                 best.alias("best_district")))


def home_metrics(star: Star) -> DataFrame:
    """A-8: latest day (text), cities and districts monitored, average current AQI and its band.

    Four global aggregates, each a single row, cross-joined (bounded 1x1).
    """
    latest = latest_local_day(star).select(F.col("_latest_day").cast("string").alias("latest_date"))
    loc = star.location_dim.agg(F.count_distinct("city").alias("city_count"),
                                F.count_distinct("district").alias("district_count"))
    cur = latest_district_aqi(star).agg(round_avg("aqi", 0).alias("avg_aqi"))
    out = latest.crossJoin(loc).crossJoin(cur)
    return out.withColumn("aqi_band", aqi_band("avg_aqi"))


def country_coverage(star: Star) -> DataFrame:
    """A-7: per country, cities and districts reporting and average current AQI."""
    return (latest_district_aqi(star).groupBy("country")
            .agg(F.count_distinct("city").alias("cities"), F.count_distinct("district").alias("districts"),
                 round_avg("aqi", 0).alias("avg_aqi"))
            .orderBy(F.col("country").asc_nulls_last()))


def freshness(star: Star, now, display_tz: str = "UTC") -> DataFrame:
    """B-8: latest UTC reading shown in ``display_tz``, minutes since (boundary count), status.

    ``now`` is a parameter (a ``datetime`` or a Column such as
    ``current_timestamp()``), interpreted in ``display_tz`` wall-clock time.
    """
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    latest = star.latest_utc_dates(1).fact.agg(F.max("utc_timestamp").alias("_max_utc"))
    shown = F.convert_timezone(F.lit("UTC"), F.lit(display_tz), F.col("_max_utc"))
    out = latest.select(shown.alias("latest_reading"),
                        boundary_diff("MINUTE", shown, now_col).alias("minutes_old"))
    return out.withColumn("status", freshness_status("minutes_old"))


# Page queries for one selected local day: the fact is pruned to that day's UTC-date partitions first.

def city_day_series(star: Star, country: str, city: str, date, pollutant: str | None = None) -> DataFrame:
    """Page 2: hourly series of one city and local day (B-3 on a pruned star)."""
    return city_hourly_series(hourly_city_agg(star.for_local_dates(date)), country, city, date, pollutant)


def district_day_series(star: Star, country: str, city: str, district: str, date,
                        pollutant: str | None = None) -> DataFrame:
    """Page 3: hourly series of one district and local day (B-4 on a pruned star)."""
    return district_hourly_series(hourly_district_detail(star.for_local_dates(date)), country, city, district,
                                  date, pollutant)


def city_day_map(star: Star, country: str, city: str, date) -> tuple[DataFrame, DataFrame]:
    """Page 4: district rows and their summary for one city and local day (B-5, A-9 on a pruned star)."""
    daily = daily_district_aqi(star.for_local_dates(date))
    return map_rows(daily, country, city, date), map_summary(daily, country, city, date)
