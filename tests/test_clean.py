"""Clean layer edge cases: JSON paths, presence filter (D9), rounding, latest-file-wins (D8)."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from airmart.operators.clean import clean, flatten_payload
from airmart.operators.quality import split_valid, stage_checks

RAW_SCHEMA = ("doc string, country string, city string, district string, year int, month int, day int, "
              "_stg_file_name string, _stg_file_load_ts timestamp_ntz, _stg_file_md5 string, "
              "_copy_data_ts timestamp, _copy_data_user string, _copy_data_role string")


def doc(epoch=1704067200, name="Ate", lat=-12.03, lon=-76.92, pm25=17.1, uv=3.7, last_updated="2024-01-01 00:00",
        drop_last_updated=False, **extra):
    cur = {"last_updated": last_updated, "last_updated_epoch": epoch, "temp_c": 21.2, "humidity": 78, "uv": uv,
           "condition": {"text": "Sunny", "code": 1000},
           "air_quality": {"pm2_5": pm25, "pm10": 40.25, "co": 310.4, "no2": 18.2, "o3": 22.1, "so2": 6.3,
                           "us-epa-index": 2, "gb-defra-index": 2}}
    cur.update(extra)
    if drop_last_updated:
        del cur["last_updated"]
    return json.dumps({"location": {"name": name, "region": "Lima", "country": "Peru", "lat": lat, "lon": lon,
                                    "tz_id": "America/Lima", "localtime_epoch": epoch + 7}, "current": cur})


def raw_rows(spark, rows, lenient=False):
    base = []
    for i, (d, load_ts) in enumerate(rows):
        base.append((d, "peru", "lima", "ate", 2024, 1, 1, f"country=peru/city=lima/district=ate/f{i}.json",
                     load_ts, f"md5-{i}", dt.datetime(2024, 1, 1), "u", "r"))
    df = spark.createDataFrame(base, RAW_SCHEMA)
    parse = F.try_parse_json if lenient else F.parse_json
    return df.select(parse("doc").alias("raw"), *[c for c in df.columns if c != "doc"])


def test_paths_types_and_rounding(spark):
    r = flatten_payload(raw_rows(spark, [(doc(pm25=12.345, uv=3.7), dt.datetime(2024, 1, 1, 0, 5))])).first()
    assert r.pm2_5 == Decimal("12.35")          # NUMBER(10,2) rounds half up
    assert r.uv_index == 4                       # ::NUMBER rounds, does not truncate
    assert r.us_epa_index == 2                   # quoted key "us-epa-index"
    assert r.latitude == Decimal("-12.0300000")
    assert r.measurement_ts == dt.datetime(2024, 1, 1, 0, 0)
    assert r.request_epoch == 1704067207
    assert r.weather_condition == "Sunny" and r.weather_condition_code == 1000


def test_presence_filter_json_null_vs_missing(spark):
    rows = [(doc(last_updated=None), dt.datetime(2024, 1, 1)),             # JSON null: kept
            (doc(drop_last_updated=True, epoch=1704070800), dt.datetime(2024, 1, 1))]  # missing: dropped
    out = flatten_payload(raw_rows(spark, rows)).collect()
    assert len(out) == 1 and out[0].measurement_epoch == 1704067200


def test_latest_file_wins_with_null_and_ties(spark):
    t = dt.datetime(2024, 1, 1, 1)
    rows = [(doc(pm25=1.0), t), (doc(pm25=2.0), t + dt.timedelta(hours=1)),     # key A: later load wins
            (doc(epoch=1704070800, pm25=3.0), t), (doc(epoch=1704070800, pm25=4.0), None)]  # key B: NULL first
    out = {r.measurement_epoch: r.pm2_5 for r in clean(raw_rows(spark, rows)).collect()}
    assert out == {1704067200: Decimal("2.00"), 1704070800: Decimal("4.00")}


def test_equal_load_times_break_on_file_name(spark):
    t = dt.datetime(2024, 1, 1, 1)
    rows = [(doc(pm25=5.0), t), (doc(pm25=6.0), t)]   # f0 / f1: f1 sorts last, DESC picks it
    assert [r.pm2_5 for r in clean(raw_rows(spark, rows)).collect()] == [Decimal("6.00")]


def test_shared_coordinates_collapse_and_order_invariance(spark):
    t = dt.datetime(2024, 1, 1, 1)
    rows = [(doc(pm25=float(i)), t + dt.timedelta(minutes=i)) for i in range(20)]
    a = clean(raw_rows(spark, rows)).collect()
    b = clean(raw_rows(spark, list(reversed(rows))).repartition(7)).collect()
    assert len(a) == 1 and a[0].pm2_5 == b[0].pm2_5 == Decimal("19.00")


def test_malformed_document(spark):
    rows = [("{not json", dt.datetime(2024, 1, 1)), (doc(), dt.datetime(2024, 1, 1))]
    with pytest.raises(Exception):
        raw_rows(spark, rows).count() and raw_rows(spark, rows).collect()
    lenient = raw_rows(spark, rows, lenient=True)
    checks = {r.test_name: (r.result, r.metric) for r in stage_checks(lenient).collect()}
    assert checks["Stage 8: JSON Validity"] == ("FAIL", 1.0)


def test_uncastable_value_strict_fails_lenient_rejects(spark):
    rows = [(doc(pm25="n/a"), dt.datetime(2024, 1, 1)), (doc(epoch=1704070800), dt.datetime(2024, 1, 1))]
    raw = raw_rows(spark, rows)
    with pytest.raises(Exception):
        flatten_payload(raw).collect()
    accepted, rejected = split_valid(raw)
    assert accepted.count() == 2   # the bad value becomes NULL; pm2_5 is not a required field
    bad = raw_rows(spark, [(doc(name=None), dt.datetime(2024, 1, 1)), (doc(pm25=900.0), dt.datetime(2024, 1, 1))])
    reasons = sorted(r.reasons for r in split_valid(bad)[1].collect())
    assert reasons == ["null", "range"]
