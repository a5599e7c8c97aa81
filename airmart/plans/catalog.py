"""SQL surface: the mart's tables, views and functions under the names SQL callers use.

``register(spark, wh)`` makes every layer and serving view of a build
queryable with ``spark.sql`` (temporary views over the materialized tables and
the DataFrame views), and ``register_functions(spark)`` defines the four
pollution/name functions as SQL functions, so dashboard SQL such as
``SELECT ... FROM vw_daily_city_agg WHERE measurement_date = (SELECT max(...))``
runs unchanged apart from the database prefix. The SQL bodies come from the
same text builders (``functions.sqltext``) as the library's name-based fast
path; the tests check them against the Column-API form.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions import sqltext
from ..operators import views as v
from ..operators.consumption import aqi_current, aqi_daily
from .warehouse import Warehouse

ARGS = "pm25 DECIMAL(38,9), pm10 DECIMAL(38,9), so2 DECIMAL(38,9), no2 DECIMAL(38,9), co DECIMAL(38,9), o3 DECIMAL(38,9)"
_P = ("pm25", "pm10", "so2", "no2", "co", "o3")


def function_sql() -> dict[str, str]:
    """Signatures and bodies of the SQL functions, from the shared SQL text builders."""
    return {
        "format_location_name": f"(name STRING) RETURNS STRING RETURN {sqltext.format_name('name')}",
        "prominent_pollutant": f"({ARGS}) RETURNS STRING RETURN {sqltext.prominent(_P)}",
        "aqi_criteria_met": f"({ARGS}) RETURNS INT RETURN {sqltext.criteria(_P)}",
        "calculate_custom_aqi": f"({ARGS}) RETURNS DECIMAL(10,2) RETURN {sqltext.custom_aqi(_P)}",
    }


def register_functions(spark: SparkSession) -> list[str]:
    names = []
    for name, body in function_sql().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    return names


def register(spark: SparkSession, wh: Warehouse) -> list[str]:
    """Temporary views for every layer and serving view of ``wh``; returns their names."""
    star = wh.star
    views = {
        "raw_aqi": wh.raw,
        "clean_aqi_dt": wh.clean,
        "aqi_consumption_dt": wh.consumption,
        "date_dim": star.date_dim,
        "location_dim": star.location_dim,
        "air_quality_fact": star.fact.drop("utc_date"),
        "vw_aqi_daily": aqi_daily(wh.consumption),
        "vw_aqi_current": aqi_current(wh.consumption),
        "vw_daily_city_agg": v.daily_city_agg(star),
        "vw_hourly_city_agg": v.hourly_city_agg(star),
        "vw_hourly_district_detail": v.hourly_district_detail(star),
        "vw_latest_district_aqi": v.latest_district_aqi(star),
        "vw_daily_district_aqi": v.daily_district_aqi(star),
        "vw_location_hierarchy": v.location_hierarchy(star),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_functions(spark)
    return list(views)
