"""Incremental refresh equals a batch rebuild over the same landing files (T-1..T-3), and costs what a batch touches."""

import datetime as dt
import json
import os
from collections import Counter

from pyspark.sql import functions as F

from airmart.plans.warehouse import build_warehouse
from airmart.sources.landing import read_landing, write_landing
from airmart.sources.readings import raw_aqi
from airmart.streaming.incremental import RAW_COLUMNS, IncrementalMart, hourly_counts, run_hourly_counts, run_incremental
from tests.conftest import SF_SMALL


def test_incremental_equals_batch(spark, tmp_dir):
    raw_aqi(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw0")
    raw = spark.read.parquet(f"{tmp_dir}/raw0")
    ts = F.col("_stg_file_load_ts")
    c1, c2 = dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)
    deliveries = [raw.where(ts < c1), raw.where((ts >= c1) & (ts < c2)),
                  # the last delivery re-sends an already published day: newer files must win
                  raw.where(ts >= c2).unionByName(raw.where(F.to_date(ts) == F.lit(dt.date(2024, 1, 2))))]
    land = f"{tmp_dir}/landing"
    for part in deliveries:
        write_landing(part, land, compression="gzip")
        run_incremental(spark, land, f"{tmp_dir}/inc", f"{tmp_dir}/ckpt", layout="lines").awaitTermination()
    # A run with no new files changes nothing.
    run_incremental(spark, land, f"{tmp_dir}/inc", f"{tmp_dir}/ckpt", layout="lines").awaitTermination()

    mart = IncrementalMart(spark, f"{tmp_dir}/inc").warehouse()
    inc = mart.consumption.drop("_copy_data_ts")
    batch = build_warehouse(spark, read_landing(spark, land, layout="lines"), f"{tmp_dir}/batch")
    bat = batch.consumption.drop("_copy_data_ts")
    assert inc.count() == bat.count() > 0
    assert inc.exceptAll(bat).count() == 0 and bat.exceptAll(inc).count() == 0
    fact_inc = mart.star.fact.drop("_copy_data_ts", "utc_date")
    fact_bat = batch.star.fact.drop("_copy_data_ts", "utc_date")
    assert fact_inc.exceptAll(fact_bat).count() == 0 and fact_bat.exceptAll(fact_inc).count() == 0
    assert mart.raw.count() == batch.raw.count()
    star_inc = mart.star
    for dim in ("date_dim", "location_dim"):
        a = getattr(star_inc, dim)
        b = getattr(batch.star, dim)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_processing_time_trigger_refreshes(spark, tmp_dir):
    """T-2: the continuous form (processing-time trigger) picks up files as they land."""
    import time

    raw_aqi(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw0")
    raw = spark.read.parquet(f"{tmp_dir}/raw0")
    land = f"{tmp_dir}/landing"
    write_landing(raw.where(F.to_date("_stg_file_load_ts") == F.lit(dt.date(2024, 1, 5))), land)
    q = run_incremental(spark, land, f"{tmp_dir}/inc", f"{tmp_dir}/ckpt", layout="lines", available_now=False,
                        processing_time="1 second")
    try:
        deadline = time.time() + 120
        while time.time() < deadline and q.lastProgress is None:
            time.sleep(1)
        q.processAllAvailable()
        n = spark.read.parquet(f"{tmp_dir}/inc/raw_aqi").count()
        assert n == raw.where(F.to_date("_stg_file_load_ts") == F.lit(dt.date(2024, 1, 5))).count() > 0
    finally:
        q.stop()


def test_bounded_batches_equal_one_batch(spark, tmp_dir):
    """A backfill split into bounded micro-batches (maxFilesPerTrigger) gives the same mart."""
    raw_aqi(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw0")
    raw = spark.read.parquet(f"{tmp_dir}/raw0")
    land = f"{tmp_dir}/landing"
    write_landing(raw, land)
    q = run_incremental(spark, land, f"{tmp_dir}/small", f"{tmp_dir}/ckpt_small", layout="lines", max_files_per_trigger=150)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) > 1
    run_incremental(spark, land, f"{tmp_dir}/one", f"{tmp_dir}/ckpt_one", layout="lines").awaitTermination()
    a, b = (IncrementalMart(spark, f"{tmp_dir}/{k}").warehouse().consumption.drop("_copy_data_ts") for k in ("small", "one"))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


DAY = 1704067200  # 2024-01-01


def _raw(spark, readings):
    """(epoch, location, region, pm2_5, delivery) -> raw rows."""
    rows = []
    for i, (epoch, name, region, pm, delivery) in enumerate(readings):
        doc = {"location": {"name": name, "region": region, "country": "Peru", "lat": len(name), "lon": -76.5, "tz_id": "America/Lima", "localtime_epoch": epoch},
               "current": {"last_updated": "x", "last_updated_epoch": epoch, "air_quality": {"pm2_5": pm, "us-epa-index": 2}}}
        at = dt.datetime(2024, 2, 1, delivery)
        rows.append((json.dumps(doc), "peru", "lima", "ate", 2024, 1, 1, f"{delivery}-{i}.json", at, f"{delivery}-{i}", at, "me", "role"))
    ddl = ("raw string, country string, city string, district string, year int, month int, day int, _stg_file_name string, _stg_file_load_ts timestamp_ntz, "
           "_stg_file_md5 string, _copy_data_ts timestamp, _copy_data_user string, _copy_data_role string")
    return spark.createDataFrame(rows, ddl).withColumn("raw", F.parse_json("raw")).select(*RAW_COLUMNS)


def _files(root, *tables):
    return {os.path.join(d, f) for t in tables for d, _, fs in os.walk(f"{root}/{t}") for f in fs if f.endswith(".parquet")}


HOURLY = ("clean_aqi", "aqi_consumption", "air_quality_fact")


def test_a_late_reading_rewrites_its_hour_only(spark, tmp_dir):
    mart = IncrementalMart(spark, tmp_dir)
    days = [(DAY + 3600 * h + 900 * q, name, "r", 10 + h, 0) for h in range(30) for q in (0, 1) for name in ("a", "bb")]
    assert mart.append_raw(_raw(spark, days), "q-0") and mart.refresh() == 30
    before, cons = _files(tmp_dir, *HOURLY), mart.warehouse().consumption
    old = sorted(tuple(r) for r in cons.collect())
    late = [(DAY + 3600 * 5, "a", "r", 99, 1), (DAY + 3600 * 5 + 1800, "a", "r", 98, 1)]
    assert mart.append_raw(_raw(spark, late), "q-1") and mart.refresh() == 1
    new = _files(tmp_dir, *HOURLY) - before
    assert new and all("/utc_date=2024-01-01/batch_id=" in f for f in new) and before <= _files(tmp_dir, *HOURLY)
    assert {r.utc_hour for f in new for r in spark.read.parquet(f).select("utc_hour").distinct().collect()} == {5}
    rows = {(r.aqi_timestamp_utc, r.location_name): (float(r.pm2_5), r.readings_in_hour) for r in mart.warehouse().consumption.collect()}
    assert len(rows) == 60 and rows[dt.datetime(2024, 1, 1, 5), "a"] == (70.67, 3) and rows[dt.datetime(2024, 1, 1, 5), "bb"] == (15.0, 2)
    assert sorted(tuple(r) for r in cons.collect()) == old                       # a reader keeps its version
    assert not mart.append_raw(_raw(spark, late), "q-1") and mart.refresh() == 0  # a transaction lands once


def test_dimension_rows_leave_when_their_count_reaches_zero(spark, tmp_dir):
    mart = IncrementalMart(spark, tmp_dir)
    mart.append_raw(_raw(spark, [(DAY, "a", "old", 1, 0), (DAY + 3600, "a", "old", 1, 0), (None, "a", "old", 1, 0)]), "q-0")
    mart.refresh()
    regions = lambda: sorted(r.region for r in mart.warehouse().star.location_dim.collect())
    assert regions() == ["old"]
    mart.append_raw(_raw(spark, [(DAY, "a", "new", 1, 1)]), "q-1")
    mart.refresh()
    assert regions() == ["new", "old"] and mart.compact() and regions() == ["new", "old"]
    mart.append_raw(_raw(spark, [(DAY + 3600, "a", "new", 1, 2), (None, "a", "new", 2, 2)]), "q-2")
    mart.refresh()
    assert regions() == ["new"]
    assert mart.warehouse().star.date_dim.count() == 3  # two hours and the reading without a time


def test_batches_stay_flat_and_folders_bounded(spark, tmp_dir):
    """Many small batches: each writes its own hour only; compaction bounds raw folders, dimension counts and the log."""
    mart = IncrementalMart(spark, tmp_dir, compact_every=3)
    readings, written, seconds = [], [], []
    import time
    for k in range(7):
        rows = [(DAY + 3600 * (k % 5) + 60 * k, name, "r", k, k % 20) for name in ("a", "bb", "ccc")]
        readings += rows
        before, t = _files(tmp_dir, *HOURLY), time.time()
        mart.append_raw(_raw(spark, rows), f"q-{k}")
        assert mart.refresh() == 1
        seconds.append(time.time() - t)
        written.append(len(_files(tmp_dir, *HOURLY) - before))
        if mart.log.version().since_snapshot >= mart.compact_every:
            mart.compact()
            mart.vacuum(grace_seconds=0)
    assert max(written) <= 6 and min(seconds[-3:]) < 2 * min(seconds[:3])
    folders = Counter(d.split(f"{tmp_dir}/")[1].split("/")[0] for d, _, fs in os.walk(tmp_dir) if any(f.endswith(".parquet") for f in fs))
    assert folders["clean_aqi"] <= 1 + 4 and folders["raw_aqi"] <= 1 + 4 and folders["location_dim_counts"] <= 1 + 4
    assert len(_files(tmp_dir, "commits")) <= 1 + 2 * 4
    one = IncrementalMart(spark, f"{tmp_dir}/one")
    one.append_raw(_raw(spark, readings), "all")
    one.refresh()
    a, b = mart.warehouse(), one.warehouse()
    for x, y in ((a.consumption, b.consumption), (a.star.location_dim, b.star.location_dim), (a.star.date_dim, b.star.date_dim), (a.raw.select("_stg_file_name", "raw").select(F.to_json("raw").alias("j")), b.raw.select(F.to_json("raw").alias("j")))):
        x, y = (d.drop("_copy_data_ts", "_stg_file_load_ts") for d in (x, y))
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_crashes_leave_the_old_version(spark, tmp_dir, monkeypatch):
    """A crash between writing and committing, in a refresh and in a compaction: readers and the next try see what was there."""
    mart = IncrementalMart(spark, tmp_dir)
    for k in range(2):
        mart.append_raw(_raw(spark, [(DAY + 3600 * k, "a", "r", k, k), (DAY, "bb", "r", 50 + k, k)]), f"q-{k}")
        mart.refresh()
    want = lambda: [sorted(map(str, d.collect())) for d in (mart.warehouse().consumption, mart.warehouse().star.location_dim, mart.warehouse().raw.select("_stg_file_name"))]
    state, real = want(), mart.log.commit

    def crash(*_):
        raise RuntimeError("executor lost")

    mart.append_raw(_raw(spark, [(DAY, "a", "r", 77, 5)]), "q-3")
    monkeypatch.setattr(mart.log, "commit", crash)
    for step in (mart.refresh, lambda: mart.append_raw(_raw(spark, [(DAY, "a", "r", 78, 6)]), "q-4")):
        try:
            step()
            raise AssertionError("no crash")
        except RuntimeError:
            pass
    assert want()[:2] == state[:2]
    monkeypatch.setattr(mart.log, "commit", real)
    assert mart.append_raw(_raw(spark, [(DAY, "a", "r", 78, 6)]), "q-4") and mart.refresh() == 1
    state = want()
    assert "78.00" in str(state[0])
    monkeypatch.setattr(mart.log, "commit", crash)
    try:
        mart.compact()
        raise AssertionError("no crash")
    except RuntimeError:
        pass
    assert want() == state
    monkeypatch.setattr(mart.log, "commit", real)
    held = mart.warehouse()
    assert mart.compact() and want() == state
    assert sorted(map(str, held.consumption.collect())) == state[0]
    assert not mart.append_raw(_raw(spark, [(DAY, "a", "r", 78, 6)]), "q-4")  # known beyond the snapshot
    assert mart.vacuum(grace_seconds=3600) == 0 and mart.vacuum(grace_seconds=0) > 0 and want() == state


def test_landing_and_refresh_apart(spark, tmp_dir):
    """T-2: files land; a refresh on demand publishes them once, and a second one writes nothing."""
    land, root, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/mart", f"{tmp_dir}/ckpt"
    mart = IncrementalMart(spark, root)
    run = lambda: run_incremental(spark, land, root, ckpt, layout="lines", refresh=False, quarantine=True).awaitTermination()
    write_landing(_raw(spark, [(DAY, "a", "r", 1, 0)]), land)
    run()
    write_landing(_raw(spark, [(DAY + 3600, "a", "r", 2, 1)]), land)
    with open(f"{land}/broken.txt", "w") as f:
        f.write('{"cut": \n')
    run()
    assert mart.log.version().hours == {} and len(mart.log.version().pending()) == 2
    assert mart.refresh() == 2
    before = _files(root, "")
    assert mart.refresh() == 0 and _files(root, "") == before
    run()
    assert mart.refresh() == 0 and _files(root, "") == before
    assert mart.warehouse().consumption.count() == 2
    assert [(r._text, r._reason) for r in spark.read.parquet(f"{root}/quarantine").collect()] == [('{"cut": ', "not JSON")]


def test_windows_are_counted_in_the_stream(spark, tmp_dir):
    """T-4: a reading delivered again counts once; a changed window replaces its count."""
    land, table, ckpt = f"{tmp_dir}/land", f"{tmp_dir}/counts", f"{tmp_dir}/ckpt"
    for delivery, rows in enumerate(([(DAY, "a", "r", 1), (DAY + 600, "a", "r", 1)], [(DAY, "a", "r", 2), (DAY + 1200, "a", "r", 1), (DAY + 3600, "bb", "r", 1)], [(DAY + 600, "a", "r", 3)])):
        write_landing(_raw(spark, [(*r, delivery) for r in rows]), land)
        run_hourly_counts(spark, land, table, ckpt, layout="lines").awaitTermination()
    got = {(r.utc_hour, r.location_name): r.readings for r in hourly_counts(spark, table).collect()}
    assert got == {(dt.datetime(2024, 1, 1), "a"): 3, (dt.datetime(2024, 1, 1, 1), "bb"): 1}
