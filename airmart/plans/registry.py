"""Registered queries (one per SURVEY section 2 operator) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``. The landing table and the star schema for
an ``sf_dir`` are built once per session into the shared folder
(``plans.warehouse``); build-stage queries (flatten, dedup, roll-up) run their
operator from the materialized landing table, serving queries read the
materialized star. Results are normalized for comparison: decimals as DOUBLE,
integers as BIGINT, LTZ timestamps as NTZ (session zone UTC); hash keys, which
no other engine can reproduce, are left out.
"""

from __future__ import annotations

import datetime as _dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import aqi_criteria_met, custom_aqi, defra_category, epa_category, prominent_pollutant
from ..functions.names import format_location_name
from ..operators import dashboards as dash
from ..operators import quality as q
from ..operators import views as v
from ..operators.clean import clean, flatten_payload
from ..operators.consumption import CONSUMPTION_COLUMNS, aqi_current, aqi_daily, hourly_rollup, time_hierarchy
from ..session import new_table_root
from ..sources.landing import PARTITION_COLUMNS as LANDING_FOLDERS
from ..sources.landing import landing_keys, list_files, path_attrs, read_landing, read_landing_split, write_landing
from ..sources.readings import raw_aqi
from ..streaming.incremental import IncrementalMart, hourly_counts, run_hourly_counts, run_incremental
from . import oracle as o
from .catalog import register
from .warehouse import Warehouse, build_warehouse

FIXED_NOW = _dt.datetime.fromisoformat(o.FIXED_NOW)

_LOCK = threading.Lock()
_BUILDS: dict = {}


def use_utc(spark: SparkSession) -> None:
    """The source's timestamps are UTC; LTZ audit columns are read and written in a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The materialized mart for ``sf_dir``, built once per Spark application."""
    use_utc(spark)
    key = (spark.conf.get("spark.app.id", None) or id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        wh = _BUILDS.get(key)
        if wh is None:
            wh = build_warehouse(spark, raw_aqi(spark, sf_dir), new_table_root(spark, "mart"))
            _BUILDS[key] = wh
        return wh


def normalize(df: DataFrame) -> DataFrame:
    """Decimals and floats as DOUBLE, small integers as BIGINT, LTZ timestamps as NTZ (one projection)."""
    exprs, changed = [], False
    for f in df.schema.fields:
        t, name = f.dataType, f"`{f.name}`"
        target = ("double" if isinstance(t, (T.DecimalType, T.FloatType)) else
                  "bigint" if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)) else
                  "timestamp_ntz" if isinstance(t, T.TimestampType) else None)
        changed |= target is not None
        exprs.append(f"CAST({name} AS {target}) AS {name}" if target else name)
    return df.selectExpr(*exprs) if changed else df


def _wh(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(fn(warehouse_for(spark, sf_dir)))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _clean_rows(wh: Warehouse) -> DataFrame:
    """The clean table (``clean_aqi_dt``), as the reference's consumers and tests read it."""
    return wh.clean


def _metric(fn, alias):
    def run(wh):
        c = _clean_rows(wh)
        p = ["pm2_5", "pm10", "so2", "no2", "co", "o3"]
        return c.select("measurement_epoch", "location_name", "latitude", "longitude", fn(*p).alias(alias))
    return run


def _format_names(wh):
    slugs = wh.raw.select(F.explode(F.array("country", "city", "district")).alias("slug")).distinct()
    return slugs.select("slug", format_location_name("slug").alias("formatted"))


def _categories(wh):
    return (_clean_rows(wh).groupBy("us_epa_index", "gb_defra_index").agg(F.count(F.lit(1)).alias("readings"))
            .select("us_epa_index", "gb_defra_index", epa_category("us_epa_index").alias("epa_category"),
                    defra_category("gb_defra_index").alias("defra_category"), "readings"))


def _landing_keys(wh):
    c = wh.consumption
    return landing_keys(c, "country", "city", "district", "aqi_timestamp_utc").select(
        "location_name", "aqi_timestamp_utc", "country_slug", "city_slug", "district_slug", "year", "month", "day",
        "file_name", "partition_path")


def _path_attrs(wh):
    return wh.raw.select("_stg_file_name", *path_attrs(F.col("_stg_file_name"), prefix="path_"))


def _dims(name, key):
    def run(wh):
        return getattr(wh.star, name).drop(key)
    return run


def _fact(wh):
    return wh.star.fact.drop("aqi_pk", "date_fk", "location_fk", "utc_date")


def _split_valid(wh):
    """All readings, every tenth delivered twice (an identical copy, at a place of its own), with validity and reasons."""
    rows = q.scan_identity(wh.raw)
    copies = rows.where(F.col("_stg_file_md5") < "1a").withColumn(q.ROW, F.struct(F.concat(F.col(f"{q.ROW}.file"), F.lit("#copy")).alias("file"), F.col(f"{q.ROW}.row").alias("row")))
    return q.split_valid_report(rows.unionByName(copies))


def _quality(wh):
    return q.quality_report(wh.raw, _clean_rows(wh), now=FIXED_NOW)


SPARK: dict[str, Callable[[Warehouse], DataFrame]] = {
    "landing_keys": _landing_keys,
    "flatten_payload": lambda wh: flatten_payload(wh.raw),
    "path_attrs": _path_attrs,
    "dedup_latest_file": lambda wh: clean(wh.raw),
    "hourly_rollup": lambda wh: hourly_rollup(_clean_rows(wh)),
    "consumption": lambda wh: wh.consumption,
    "format_location_name": _format_names,
    "prominent_pollutant": _metric(prominent_pollutant, "prominent_pollutant"),
    "aqi_criteria_met": _metric(aqi_criteria_met, "criteria_pollutant_count"),
    "custom_aqi": _metric(custom_aqi, "custom_aqi"),
    "epa_defra_category": _categories,
    "time_hierarchy": lambda wh: time_hierarchy(wh.consumption),
    "date_dim": _dims("date_dim", "date_pk"),
    "location_dim": _dims("location_dim", "location_pk"),
    "air_quality_fact": _fact,
    "aqi_daily": lambda wh: aqi_daily(wh.consumption),
    "aqi_current": lambda wh: aqi_current(wh.consumption),
    "daily_city_agg": lambda wh: v.daily_city_agg(wh.star),
    "hourly_city_agg": lambda wh: v.hourly_city_agg(wh.star),
    "hourly_district_detail": lambda wh: v.hourly_district_detail(wh.star),
    "latest_district_aqi": lambda wh: v.latest_district_aqi(wh.star),
    "daily_district_aqi": lambda wh: v.daily_district_aqi(wh.star),
    "location_hierarchy": lambda wh: v.location_hierarchy(wh.star),
    "top_cities": lambda wh: dash.top_cities(wh.star),
    "filter_values": lambda wh: dash.filter_values(v.hourly_district_detail(wh.star), "measurement_date"),
    "city_hourly_series": lambda wh: dash.city_hourly_series(v.hourly_city_agg(wh.star)),
    "district_hourly_series": lambda wh: dash.district_hourly_series(v.hourly_district_detail(wh.star)),
    "map_rows": lambda wh: dash.map_rows(v.daily_district_aqi(wh.star)),
    "map_summary": lambda wh: dash.map_summary(v.daily_district_aqi(wh.star)),
    "home_metrics": lambda wh: dash.home_metrics(wh.star),
    "country_coverage": lambda wh: dash.country_coverage(wh.star),
    "freshness": lambda wh: dash.freshness(wh.star, FIXED_NOW),
    "stage_metrics": lambda wh: q.stage_metrics(wh.raw, now=FIXED_NOW),
    "stage_breakdown": lambda wh: q.stage_breakdown(wh.raw),
    "clean_metrics": lambda wh: q.clean_metrics(_clean_rows(wh)),
    "district_summary": lambda wh: q.district_summary(_clean_rows(wh)),
    "quality_report": _quality,
    "required_fields": lambda wh: q.required_fields(_clean_rows(wh)),
    "dedup_counts": lambda wh: q.dedup_counts(wh.raw, _clean_rows(wh)),
    "key_integrity": lambda wh: q.key_integrity(wh.star),
    "split_valid": _split_valid,
}


LOCAL_COLUMNS = ("_copy_data_ts", "_copy_data_user", "_copy_data_role")  # of the copy, not of the reading


def _landed(spark: SparkSession, raw: DataFrame, label: str, layout: str, **options) -> DataFrame:
    root = new_table_root(spark, label)
    write_landing(raw, f"{root}/landing", layout=layout, **options)
    return read_landing(spark, f"{root}/landing", layout=layout)


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2 -> S-3..S-6, twice: every reading as gzip JSON Lines, read back, landed again, read back and flattened; folders and
    file names hold brackets, quotes and backslashes."""
    raw = warehouse_for(spark, sf_dir).raw.withColumns({"district": F.concat("district", F.lit(" o'x:y%z+")), "_stg_file_name": F.concat("_stg_file_name", F.lit('}"\\{'))})
    once = _landed(spark, raw, "landing", "lines", compression="gzip")
    return normalize(flatten_payload(_landed(spark, once, "landing", "lines")).drop(*LOCAL_COLUMNS))


def landing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layer (latest file wins) over one document per file."""
    return normalize(clean(_landed(spark, warehouse_for(spark, sf_dir).raw, "documents", "document")).drop(*LOCAL_COLUMNS))


def _deliveries(raw: DataFrame) -> list[DataFrame]:
    """Three deliveries by load time; the last one delivers the first day again."""
    ts = F.col("_stg_file_load_ts")
    span = raw.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if span is None or span["lo"] is None:
        return []
    lo, hi = span["lo"], span["hi"]
    cut1, cut2 = lo + (hi - lo) / 3, lo + 2 * (hi - lo) / 3
    first_day = F.to_date(ts) == F.lit(lo.date())
    return [raw.where(ts < F.lit(cut1)), raw.where((ts >= F.lit(cut1)) & (ts < F.lit(cut2))),
            raw.where(ts >= F.lit(cut2)).unionByName(raw.where(first_day))]


def incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1..T-3: three deliveries (the last re-delivers the first day) through the streaming refresh, compacted on the way.

    Returns the incrementally maintained consumption table, which the tests
    compare row for row with a batch rebuild over the same landing files.
    """
    wh, root = warehouse_for(spark, sf_dir), new_table_root(spark, "incremental")
    mart = IncrementalMart(spark, f"{root}/mart")
    deliveries = _deliveries(wh.raw)
    for part in deliveries:
        write_landing(part, f"{root}/landing")
        run_incremental(spark, f"{root}/landing", mart.root, f"{root}/checkpoint", layout="lines", compact_every=4).awaitTermination()
    cons = mart.warehouse().consumption if deliveries else wh.consumption.where(F.lit(False))
    return normalize(cons.drop("_copy_data_ts"))


def refresh_on_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2: deliveries that only land, and refreshes on demand: the UTC hours each refresh rewrote and the commits it made. One
    without new files rewrites nothing, one after a late delivery the hours of that delivery."""
    wh, root = warehouse_for(spark, sf_dir), new_table_root(spark, "on-demand")
    mart = IncrementalMart(spark, f"{root}/mart")
    raw = wh.raw
    first_day = raw.where(F.to_date("_stg_file_load_ts") == raw.agg(F.min(F.to_date("_stg_file_load_ts"))).scalar())
    rows = []
    for step, part in (("all", raw), ("no file", None), ("first day again", first_day), ("no file again", None)):
        if part is not None:
            write_landing(part, f"{root}/landing")
        run_incremental(spark, f"{root}/landing", mart.root, f"{root}/checkpoint", layout="lines", refresh=False).awaitTermination()
        before = mart.log.version().seq
        hours = mart.refresh()
        rows.append((step, hours, mart.log.version().seq - before))
    return spark.createDataFrame(rows, "step string, hours_rewritten long, commits long")


def hourly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-4: readings per UTC hour and location, counted in the stream's state over three deliveries; what is delivered again
    counts once."""
    wh, root = warehouse_for(spark, sf_dir), new_table_root(spark, "windows")
    deliveries = _deliveries(wh.raw)
    for part in deliveries:
        write_landing(part, f"{root}/landing")
        run_hourly_counts(spark, f"{root}/landing", f"{root}/counts", f"{root}/checkpoint", layout="lines").awaitTermination()
    if not deliveries:
        return spark.createDataFrame([], "utc_hour timestamp_ntz, location_name string, readings long")
    return normalize(hourly_counts(spark, f"{root}/counts"))


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-6 / F-17: the audit columns of a load of all landing files, against the run that made it."""
    raw, root = warehouse_for(spark, sf_dir).raw, new_table_root(spark, "audit")
    started = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]
    _landed(spark, raw, "audit", "lines").drop("raw").write.parquet(f"{root}/loaded")
    return q.audit_checks(spark.read.parquet(f"{root}/loaded"), started)


def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3: one document in sixteen is cut off and one in sixteen is a list; accepted rows and quarantined texts with reasons."""
    raw, root = warehouse_for(spark, sf_dir).raw, new_table_root(spark, "quarantine")
    tag = F.substring("_stg_file_md5", 1, 1)
    broken = F.when(tag == "0", F.concat(F.lit('{"cut off": "'), "_stg_file_md5")).when(tag == "1", F.concat(F.lit('["'), "_stg_file_md5", F.lit('"]')))
    write_landing(raw.withColumn("raw", F.coalesce(broken, F.to_json("raw"))), f"{root}/landing")
    accepted, kept = read_landing_split(spark, f"{root}/landing", layout="lines")
    cols = ("country", "city", "district", "year", "month", "day")
    good = accepted.select(*cols, F.col("_stg_file_md5").alias("text"), F.lit("accepted").alias("status"))
    return normalize(good.unionByName(kept.select(*cols, F.col("_text").alias("text"), F.col("_reason").alias("status"))))


def stage_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-8 / Q-11: landing files against the load history, by folder: the files of day 3 are not loaded, those of day 5 are gone."""
    wh, root = warehouse_for(spark, sf_dir), new_table_root(spark, "staged")
    plain = wh.raw.select("raw", *LANDING_FOLDERS)  # without an envelope, so a file's name is its own
    write_landing(plain, f"{root}/landing")
    loaded = read_landing(spark, f"{root}/landing", layout="lines").where("day <> 3")
    listed = list_files(spark, f"{root}/landing").where(~F.col("relative_path").like("%/day=05/%"))
    rows = q.reconcile_stage(listed, loaded)
    return normalize(rows.select(*path_attrs(F.col("_stg_file_name")), "status").distinct())


def quality_report_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-1 / Q-11 / Q-13: the report with the stage's listing (day 3 listed under other names, day 5 gone) and the catalog's
    objects (one of the names is missing)."""
    wh = warehouse_for(spark, sf_dir)
    register(spark, wh)
    listing = wh.raw.where("day <> 5").select(F.when(F.col("day") == 3, F.replace("_stg_file_name", F.lit("/e_"), F.lit("/late_"))).otherwise(F.col("_stg_file_name")).alias("relative_path"))
    names = ("raw_aqi", "clean_aqi_dt", "aqi_consumption_dt", "date_dim", "location_dim", "air_quality_fact", "vw_location_hierarchy", "missing_dt")
    return normalize(q.quality_report(wh.raw, _clean_rows(wh), now=FIXED_NOW, files=listing, tables=names))


def _page(fn):
    """A page query on the star, restricted to a selection that all test tables hold."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(fn(warehouse_for(spark, sf_dir).star))
    return run


# The selection of the drill-down pages.
PAGE = {"country": "India", "city": "New Delhi", "date": "2024-01-10"}
DISTRICT = "Santa Anita"

LANDED = {"landing_roundtrip": landing_roundtrip, "landing_documents": landing_documents, "incremental_equals_batch": incremental_mart,
          "refresh_on_demand": refresh_on_demand, "hourly_windows": hourly_windows, "audit_columns": audit_columns,
          "landing_quarantine": landing_quarantine, "stage_reconciliation": stage_reconciliation, "quality_report_stage": quality_report_stage}
PAGES = {
    "page_city_day": _page(lambda star: dash.city_day_series(star, **PAGE, pollutant="PM10")),
    "page_district_day": _page(lambda star: dash.district_day_series(star, PAGE["country"], PAGE["city"], DISTRICT, PAGE["date"], "O3")),
    "page_map_rows": _page(lambda star: dash.city_day_map(star, **PAGE)[0]),
    "page_map_summary": _page(lambda star: dash.city_day_map(star, **PAGE)[1]),
    "page_districts": _page(lambda star: dash.filter_values(v.hourly_district_detail(star), "district", country=PAGE["country"], city=PAGE["city"])),
    "freshness_lima": _page(lambda star: dash.freshness(star, FIXED_NOW, "America/Lima")),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _wh(fn) for name, fn in SPARK.items()}
    return out | LANDED | PAGES


def oracle_sql() -> dict[str, str]:
    from .oracle_queries import ORACLE
    return {name: ORACLE[name] for name in (*SPARK, *LANDED, *PAGES) if name in ORACLE}
