"""Parameterized drill-down queries against brute force over the collected view rows."""

import statistics
from decimal import ROUND_HALF_UP, Decimal

from airmart.operators import dashboards as dash
from airmart.operators import views as v
from airmart.plans.registry import warehouse_for
from tests.conftest import SF_SMALL


def test_cascading_filters_and_series(spark):
    star = warehouse_for(spark, SF_SMALL).star
    detail = v.hourly_district_detail(star)
    rows = detail.collect()
    countries = [r.country for r in dash.filter_values(detail, "country").collect()]
    assert countries == sorted({r.country for r in rows})
    country = countries[0]
    cities = [r.city for r in dash.filter_values(detail, "city", country=country).collect()]
    assert cities == sorted({r.city for r in rows if r.country == country})
    city = cities[0]
    districts = [r.district for r in dash.filter_values(detail, "district", country=country, city=city).collect()]
    assert districts == sorted({r.district for r in rows if r.country == country and r.city == city})
    district = districts[0]
    dates = [r.measurement_date for r in dash.filter_values(detail, "measurement_date", country=country, city=city,
                                                            district=district).collect()]
    assert dates == sorted({r.measurement_time.date() for r in rows
                            if (r.country, r.city, r.district) == (country, city, district)}, reverse=True)
    day = dates[0]
    series = dash.district_hourly_series(detail, country, city, district, day.isoformat(), pollutant="PM10").collect()
    expect = sorted((r for r in rows if (r.country, r.city, r.district) == (country, city, district)
                     and r.measurement_time.date() == day), key=lambda r: r.aqi_hour)
    assert [s.hour for s in series] == [f"{r.aqi_hour:02d}:00" for r in expect]
    assert [s.pm10_avg for s in series] == [r.pm10_avg for r in expect]
    hc = dash.city_hourly_series(v.hourly_city_agg(star), country, city, day, pollutant="PM2.5").collect()
    assert [r.hour for r in hc] == sorted(r.hour for r in hc) and set(hc[0].asDict()) == {"hour", "pm25_avg"}


def test_map_summary_matches_brute_force(spark):
    star = warehouse_for(spark, SF_SMALL).star
    dd = v.daily_district_aqi(star)
    pick = dd.orderBy("country", "city", "measurement_date").first()
    args = (pick.country, pick.city, pick.measurement_date)
    rows = dash.map_rows(dd, *args).collect()
    assert [r.aqi for r in rows] == sorted((r.aqi for r in rows), reverse=True)
    s = dash.map_summary(dd, *args).first()
    aqis = [r.aqi for r in rows]
    assert s.districts == len(rows) and s.max_aqi == max(aqis) and s.min_aqi == min(aqis)
    exact = Decimal(sum(aqis)) / len(aqis)
    assert s.avg_aqi == exact.quantize(Decimal(1), rounding=ROUND_HALF_UP)
    assert s.worst_district == min(r.district for r in rows if r.aqi == max(aqis))
    assert s.best_district == min(r.district for r in rows if r.aqi == min(aqis))
    assert statistics.mean(float(a) for a in aqis) >= float(s.min_aqi)


def test_top_cities_is_the_latest_day_of_the_daily_view(spark):
    star = warehouse_for(spark, SF_SMALL).star
    daily = v.daily_city_agg(star).collect()
    latest = max(r.measurement_date for r in daily)
    expect = sorted((r for r in daily if r.measurement_date == latest), key=lambda r: (-r.aqi, r.country, r.city))
    got = dash.top_cities(star).collect()
    assert [(r.country, r.city, r.aqi) for r in got] == [(r.country, r.city, r.aqi) for r in expect[:10]]


def test_day_pages_prune_utc_partitions_and_match(spark):
    star = warehouse_for(spark, SF_SMALL).star
    detail = v.hourly_district_detail(star)
    pick = detail.orderBy("country", "city", "district", "measurement_time").first()
    day = pick.measurement_time.date()
    full = dash.district_hourly_series(detail, pick.country, pick.city, pick.district, day).collect()
    pruned_df = dash.district_day_series(star, pick.country, pick.city, pick.district, day)
    assert pruned_df.collect() == full
    plan = pruned_df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(utc_date" in plan
    rows, summary = dash.city_day_map(star, pick.country, pick.city, day)
    assert rows.collect() == dash.map_rows(v.daily_district_aqi(star), pick.country, pick.city, day).collect()
    assert summary.count() == 1
    series = dash.city_day_series(star, pick.country, pick.city, day, "PM2.5").collect()
    assert len(series) > 0
