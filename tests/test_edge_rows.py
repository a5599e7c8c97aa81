"""Hand-made edge rows through clean -> hourly -> views (D2, D5, D18)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from airmart.operators.clean import clean
from airmart.operators.consumption import aqi_current, build_consumption
from airmart.operators.quality import key_integrity
from airmart.operators.star import star_from_consumption

RAW_SCHEMA = ("doc string, country string, city string, district string, year int, month int, day int, "
              "_stg_file_name string, _stg_file_load_ts timestamp_ntz, _stg_file_md5 string, "
              "_copy_data_ts timestamp, _copy_data_user string, _copy_data_role string")


def _doc(epoch, name, lat, lon, tz, pm25=10.0):
    return json.dumps({
        "location": {"name": name, "region": "r", "country": "c", "lat": lat, "lon": lon, "tz_id": tz,
                     "localtime_epoch": epoch},
        "current": {"last_updated": "x", "last_updated_epoch": epoch, "temp_c": 1.0, "humidity": 1,
                    "air_quality": {"pm2_5": pm25, "pm10": 1.0, "so2": 1.0, "no2": 1.0, "co": 1.0, "o3": 1.0,
                                    "us-epa-index": 1, "gb-defra-index": 1}}})


def _raw(spark, rows):
    out = []
    for i, (d, country, district) in enumerate(rows):
        out.append((d, country, "new_york", district, 2024, 11, 3, f"f{i}.json", dt.datetime(2024, 11, 4, 0, i),
                    f"m{i}", dt.datetime(2024, 11, 4), "u", "r"))
    df = spark.createDataFrame(out, RAW_SCHEMA)
    return df.select(F.parse_json("doc").alias("raw"), *[c for c in df.columns if c != "doc"])


def test_dst_fall_back_gives_two_rows_per_local_hour(spark):
    # 05:30 and 06:30 UTC on 2024-11-03 are both 01:30 in New York (DST ends).
    rows = [(_doc(1730611800, "ny", 40.7, -74.0, "America/New_York"), "united_states", "manhattan"),
            (_doc(1730615400, "ny", 40.7, -74.0, "America/New_York"), "united_states", "manhattan")]
    cons = build_consumption(clean(_raw(spark, rows))).collect()
    assert len(cons) == 2
    assert {r.aqi_timestamp for r in cons} == {dt.datetime(2024, 11, 3, 1, 0)}
    assert {r.aqi_timestamp_utc for r in cons} == {dt.datetime(2024, 11, 3, 5), dt.datetime(2024, 11, 3, 6)}
    star = star_from_consumption(build_consumption(clean(_raw(spark, rows))))
    checks = {r.test_name: r.result for r in key_integrity(star).collect()}
    assert checks["air_quality_fact.aqi_pk unique"] == "FAIL"    # reported, as decided for D2


def test_dedup_key_ignores_district(spark):
    # Same epoch, name and coordinates from two districts: one clean row (D5), the later file.
    rows = [(_doc(1730611800, "shared", -12.0, -77.0, "America/Lima", pm25=1.0), "peru", "ate"),
            (_doc(1730611800, "shared", -12.0, -77.0, "America/Lima", pm25=2.0), "peru", "rimac")]
    out = clean(_raw(spark, rows)).collect()
    assert len(out) == 1 and out[0].district == "rimac"


def test_current_status_drops_null_district_and_keeps_ties(spark):
    rows = [(_doc(1730611800, "a", -12.0, -77.0, "America/Lima"), "peru", "ate"),
            (_doc(1730611800, "b", -12.1, -77.1, "America/Lima"), "peru", "ate"),       # same latest hour
            (_doc(1730608200, "c", -12.2, -77.2, "America/Lima"), "peru", "ate"),       # older hour
            (_doc(1730611800, "d", -12.3, -77.3, "America/Lima"), "peru", None)]        # NULL district
    cur = aqi_current(build_consumption(clean(_raw(spark, rows)))).collect()
    assert sorted(r.location_name for r in cur) == ["a", "b"]


def test_arg_scale_zero_through_consumption(spark):
    """D3: with arg_scale=0 each pollutant is rounded to an integer before the metric functions."""
    from decimal import ROUND_HALF_UP, Decimal

    from airmart.plans.registry import warehouse_for
    from tests.conftest import SF_SMALL

    clean_t = warehouse_for(spark, SF_SMALL).clean
    rows = build_consumption(clean_t, arg_scale=0).collect()
    assert rows

    def r0(x):
        return None if x is None else x.quantize(Decimal(1), rounding=ROUND_HALF_UP)

    for r in rows:
        p = [r0(x) for x in (r.pm2_5, r.pm10, r.so2, r.no2, r.co, r.o3)]
        pm = 1 if any(x is not None and x > 0 for x in p[:2]) else 0
        crit = pm + min(2, sum(1 for x in p[2:] if x is not None and x > 0))
        assert r.criteria_pollutant_count == crit
        top = max(x if x is not None else Decimal(0) for x in p)
        assert r.custom_aqi == (top if crit >= 3 else Decimal(0))
