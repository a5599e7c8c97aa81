"""SQL surface: views and SQL functions give the same answers as the DataFrame API."""

from pyspark.sql import functions as F

from airmart.functions import aqi_criteria_met, custom_aqi, format_location_name, prominent_pollutant
from airmart.operators import dashboards as dash
from airmart.plans.catalog import register
from airmart.plans.registry import warehouse_for
from tests.conftest import SF_SMALL


def test_sql_views_and_functions(spark):
    wh = warehouse_for(spark, SF_SMALL)
    names = register(spark, wh)
    assert "vw_daily_city_agg" in names and spark.catalog.tableExists("air_quality_fact")

    top_sql = spark.sql("""
        SELECT country, city, aqi FROM vw_daily_city_agg
        WHERE measurement_date = (SELECT max(measurement_date) FROM vw_daily_city_agg)
        ORDER BY aqi DESC, country, city LIMIT 10""").collect()
    top_df = dash.top_cities(wh.star).select("country", "city", "aqi").collect()
    assert top_sql == top_df

    pick = spark.sql("SELECT country, city, to_date(measurement_time) AS d FROM vw_hourly_city_agg "
                     "ORDER BY 1, 2, 3 LIMIT 1").first()
    hourly = spark.sql("""
        SELECT lpad(CAST(aqi_hour AS STRING), 2, '0') || ':00' AS hour, pm25_avg FROM vw_hourly_city_agg
        WHERE country = :country AND city = :city AND to_date(measurement_time) = :d
        ORDER BY aqi_hour""", args={"country": pick.country, "city": pick.city, "d": pick.d}).collect()
    same = dash.city_hourly_series(spark.table("vw_hourly_city_agg"), pick.country, pick.city, pick.d,
                                   "PM2.5").collect()
    assert len(hourly) > 0 and [tuple(r) for r in hourly] == [tuple(r) for r in same]

    c = wh.clean
    p = [F.col(x) for x in ("pm2_5", "pm10", "so2", "no2", "co", "o3")]
    args = "pm2_5, pm10, so2, no2, co, o3"
    both = c.select(
        prominent_pollutant(*p).alias("a1"), F.expr(f"prominent_pollutant({args})").alias("b1"),
        aqi_criteria_met(*p).alias("a2"), F.expr(f"aqi_criteria_met({args})").alias("b2"),
        custom_aqi(*p).alias("a3"), F.expr(f"calculate_custom_aqi({args})").alias("b3"),
        format_location_name("district").alias("a4"), F.expr("format_location_name(district)").alias("b4"))
    bad = both.where(~(F.col("a1").eqNullSafe(F.col("b1")) & F.col("a2").eqNullSafe(F.col("b2"))
                       & F.col("a3").eqNullSafe(F.col("b3")) & F.col("a4").eqNullSafe(F.col("b4"))))
    assert bad.count() == 0 and both.count() > 0


def test_table_existence_checks(spark):
    from airmart.operators.quality import table_checks
    register(spark, warehouse_for(spark, SF_SMALL))
    got = {r.test_name: r.result for r in table_checks(spark, ("raw_aqi", "vw_location_hierarchy", "nope")).collect()}
    assert got == {"Exists: raw_aqi": "PASS", "Exists: vw_location_hierarchy": "PASS", "Exists: nope": "FAIL"}
