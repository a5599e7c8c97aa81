"""Data-quality checks and reports (Q-1..Q-14, A-12..A-14).

Every check yields ``(test_name, result, metric)``. The stage checks are one
global aggregate over the raw table and the clean checks one over the clean
table (a single scan each, partial aggregation on the map side); the rows are
then produced with ``inline`` rather than by running one job per check. The
duplicate and key checks are a group-by each. Defects of the reference's
scripts are decided in SURVEY D11-D14: duplicates PASS when no key repeats,
the dedup check compares like with like, the district threshold is a
parameter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.agg import round_avg
from ..functions.timefn import boundary_diff
from .clean import DEDUP_KEYS, ORDER_COLUMNS, flatten_payload, latest_file_order
from .star import Star

CHECK_SCHEMA = "test_name string, result string, metric double"

# Fixed values (with the check titles below): accepted ranges of the numeric check (inclusive bounds).
RANGES = (("pm2_5", 0, 500), ("pm10", 0, 500), ("temp_c", -50, 60), ("humidity", 0, 100),
          ("us_epa_index", 1, 6))
REQUIRED_FIELDS = ("measurement_ts", "location_name", "latitude", "longitude", "_stg_file_name")
METADATA_FIELDS = ("_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts")
PARTITION_FIELDS = ("country", "city", "district", "year", "month", "day")


def _flag_sum(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def _any_null(cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def range_violation() -> Column:
    out = F.lit(False)
    for c, lo, hi in RANGES:
        out = out | F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False))
    return out


def _row(name: str, result: Column, metric: Column) -> Column:
    return F.struct(F.lit(name).alias("test_name"), result.alias("result"), metric.cast("double").alias("metric"))


def _pass(cond: Column, otherwise: str) -> Column:
    return F.when(cond, F.lit("PASS")).otherwise(F.lit(otherwise))


def _now(now) -> Column:
    if isinstance(now, Column):
        return now.cast("timestamp_ntz")
    return F.lit(now if now is not None else _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast(
        "timestamp_ntz")


def _invalid_json(raw: DataFrame) -> Column:
    if isinstance(raw.schema["raw"].dataType, T.StringType):
        return F.col("raw").isNull() | F.try_parse_json(F.col("raw")).isNull()
    return F.col("raw").isNull()


def _stage_aggregate(raw: DataFrame, country: str) -> DataFrame:
    """One row of counts over the landing table."""
    return raw.agg(
        F.count(F.lit(1)).alias("raw_n"),
        F.count_distinct(F.when(F.col("_stg_file_name").like(f"%country={country}%"), F.col("_stg_file_name"))).alias("files"),
        _flag_sum(_any_null(METADATA_FIELDS)).alias("raw_missing_meta"),
        # A VARIANT holds parsed JSON, so a non-NULL payload is valid; malformed documents reach the
        # table as NULL (lenient reader) or fail the load (strict reader). No re-serialization per row.
        _flag_sum(_invalid_json(raw)).alias("invalid"),
        _flag_sum(F.col("country") == country).alias("country_rows"),
        _flag_sum(_any_null(PARTITION_FIELDS)).alias("missing_parts"))


def _stage_rows() -> list[Column]:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return [
        _row("Stage 4: Data Existence", _pass(F.col("raw_n") > 0, "WARN"), F.col("raw_n")),
        _row("Stage 6: Files in Stage", _pass(F.col("files") > 0, "WARN"), F.col("files")),
        _row("Stage 7: Metadata Completeness", _pass(zero("raw_missing_meta") == 0, "FAIL"), zero("raw_missing_meta")),
        _row("Stage 8: JSON Validity", _pass(zero("invalid") == 0, "FAIL"), zero("invalid")),
        _row("Stage 9: Country Data", _pass(zero("country_rows") > 0, "WARN"), zero("country_rows")),
        _row("Stage 10: Partition Attributes", _pass(zero("missing_parts") == 0, "FAIL"), zero("missing_parts")),
    ]


def stage_checks(raw: DataFrame, country: str = "peru") -> DataFrame:
    """Q-1, Q-7, Q-11 on the landing table (one scan)."""
    return _stage_aggregate(raw, country).select(F.inline(F.array(*_stage_rows())))


def _duplicate_aggregate(clean: DataFrame) -> DataFrame:
    groups = clean.groupBy("measurement_ts", "location_name", "latitude", "longitude").agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.count_if(F.col("copies") > 1).alias("dup_keys"))


def _duplicate_rows() -> list[Column]:
    return [_row("Clean 2: Duplicate Check", _pass(F.col("dup_keys") == 0, "FAIL"), F.col("dup_keys"))]


def duplicate_check(clean: DataFrame) -> DataFrame:
    """Q-2 / A-11: PASS when no (measurement_ts, name, lat, lon) occurs twice (D12)."""
    return _duplicate_aggregate(clean).select(F.inline(F.array(*_duplicate_rows())))


def _clean_aggregate(clean: DataFrame) -> DataFrame:
    """One row of counts over the clean table. One row per district and time zone first; distinct counts and the string
    maximum then read only these."""
    g = clean.groupBy("district", "timezone_id").agg(
        F.count(F.lit(1)).alias("n"), *(F.count(c).alias(f"has_{c}") for c in REQUIRED_FIELDS),
        F.max(F.col("_copy_data_ts").cast("timestamp_ntz")).alias("latest_load"),
        _flag_sum(range_violation()).alias("out_of_range"), _flag_sum(_any_null(METADATA_FIELDS)).alias("missing_meta"),
        F.count("temp_c").alias("with_temp"))
    return g.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.least(*[F.sum(f"has_{c}") for c in REQUIRED_FIELDS]), F.lit(0)).alias("min_required"),
        F.max("latest_load").alias("latest_load"),
        F.count_distinct("district").alias("districts"),
        F.sum("out_of_range").alias("out_of_range"),
        F.sum("missing_meta").alias("missing_meta"),
        F.count_distinct("timezone_id").alias("timezones"),
        F.max("timezone_id").alias("max_tz"),
        F.coalesce(F.sum("with_temp"), F.lit(0)).alias("with_temp"))


def _clean_rows(now, min_districts: int, expected_tz: str, with_raw: bool) -> list[Column]:
    now_c, n = _now(now), F.col("n")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    pct = F.col("with_temp") * F.lit(100.0) / F.nullif(n, F.lit(0))
    checks = [
        _row("Clean 1: Table Existence", _pass(n > 0, "FAIL"), n),
        _row("Clean 3: Required Fields", _pass(F.col("min_required") == n, "FAIL"), n),
        _row("Clean 4: Data Freshness",
             _pass(F.coalesce(F.col("latest_load") >= now_c - F.expr("INTERVAL 24 HOURS"), F.lit(False)), "WARN"),
             boundary_diff("HOUR", F.col("latest_load"), now_c)),
        _row("Clean 5: District Coverage", _pass(F.col("districts") >= min_districts, "WARN"), F.col("districts")),
        _row("Clean 6: Numeric Value Ranges", _pass(zero("out_of_range") == 0, "FAIL"), zero("out_of_range")),
        _row("Clean 7: Metadata Integrity", _pass(zero("missing_meta") == 0, "FAIL"), zero("missing_meta")),
        _row("Clean 8: Timezone Consistency",
             _pass((F.col("timezones") == 1) & F.coalesce(F.col("max_tz") == expected_tz, F.lit(False)), "WARN"),
             F.col("timezones")),
        _row("Clean 9: Weather Data Completeness",
             F.when(pct >= 95.0, "PASS").when(pct >= 80.0, "WARN").otherwise("FAIL"), F.round(pct, 2)),
    ]
    if with_raw:
        checks.append(_row("Clean 10: Deduplication Logic", _pass(n <= F.col("raw_n"), "FAIL"), F.col("raw_n") - n))
    return checks


def clean_checks(clean: DataFrame, raw: DataFrame | None = None, now=None, min_districts: int = 10,
                 expected_tz: str = "America/Lima") -> DataFrame:
    """Q-1, Q-3..Q-10 on the clean table (one scan, plus one count of raw for Q-10)."""
    a = _clean_aggregate(clean)
    if raw is not None:
        a = a.crossJoin(raw.agg(F.count(F.lit(1)).alias("raw_n")))  # J-5: two one-row aggregates
    return a.select(F.inline(F.array(*_clean_rows(now, min_districts, expected_tz, raw is not None))))


def required_fields(clean: DataFrame) -> DataFrame:
    """Q-3 in detail: rows and rows with a value, per required field."""
    a = clean.agg(F.count(F.lit(1)).alias("n"), *(F.count(c).alias(c) for c in REQUIRED_FIELDS))
    return a.select(F.inline(F.array(*(F.struct(F.lit(c).alias("field"), F.col("n").alias("row_count"), F.col(c).alias("with_value"))
                                       for c in REQUIRED_FIELDS))))


def dedup_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Q-10 in detail: rows landed and rows kept."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
    return count(raw, "raw").unionByName(count(clean, "clean"))


NOT_LOADED, GONE = "listed, not loaded", "loaded, gone"


def reconcile_stage(files: DataFrame, raw: DataFrame) -> DataFrame:
    """Q-11 / S-8: files of a listing (``list_files``) against the load history, in both directions: ``_stg_file_name`` and
    ``status`` of files that are listed and not loaded, and of loaded files that are gone. Both sides are read once, in one
    grouping by name (combined on the map side, so a task sends each name once)."""
    side = lambda df, name, listed: df.select(F.col(name).alias("_stg_file_name"), F.lit(listed).alias("listed"))
    names = side(files, "relative_path", True).unionByName(side(raw.where(F.col("_stg_file_name").isNotNull()), "_stg_file_name", False))
    found = names.groupBy("_stg_file_name").agg(F.bool_or("listed").alias("listed"), F.bool_and("listed").alias("open"))
    status = F.when(F.col("open"), F.lit(NOT_LOADED)).when(~F.col("listed"), F.lit(GONE))
    return found.select("_stg_file_name", status.alias("status")).where(F.col("status").isNotNull())


def staged_files_check(files: DataFrame, raw: DataFrame) -> DataFrame:
    """Q-11 on the stage itself: files listed, those that the raw table does not hold yet, and loaded ones that are gone."""
    open_files = reconcile_stage(files, raw).agg(F.count_if(F.col("status") == NOT_LOADED).alias("missing"), F.count_if(F.col("status") == GONE).alias("gone"))
    a = files.agg(F.count_distinct("relative_path").alias("listed")).crossJoin(open_files)  # two one-row aggregates
    return a.select(F.inline(F.array(
        _row("Stage 6: Files listed", _pass(F.col("listed") > 0, "WARN"), F.col("listed")),
        _row("Stage 6: Files not loaded", _pass(F.col("missing") == 0, "WARN"), F.col("missing")),
        _row("Stage 6: Loaded files gone", _pass(F.col("gone") == 0, "WARN"), F.col("gone")))))


def quality_report(raw: DataFrame, clean: DataFrame, now=None, country: str = "peru", min_districts: int = 10,
                   expected_tz: str = "America/Lima", files: DataFrame | None = None, tables: tuple = ()) -> DataFrame:
    """Q-13: every stage and clean check in one frame, with existence rows for catalog ``tables`` and, with a
    listing of the stage's ``files``, what is staged and not loaded. Raw is scanned once (its count serves Q-10 too)."""
    facts = _stage_aggregate(raw, country).crossJoin(_duplicate_aggregate(clean)).crossJoin(_clean_aggregate(clean))  # one row each
    out = facts.select(F.inline(F.array(*_stage_rows(), *_duplicate_rows(), *_clean_rows(now, min_districts, expected_tz, True))))
    if files is not None:
        out = out.unionByName(staged_files_check(files, raw))
    return out.unionByName(table_checks(raw.sparkSession, tables)) if tables else out


def audit_checks(raw: DataFrame, started, user: str | Column | None = None, role: str = "SYSADMIN") -> DataFrame:
    """S-6 / F-17: the audit columns of a load that began at ``started``: every row was copied since then and not after now, by
    one user (the session's unless given) and one role. The metric counts the rows that break the rule."""
    user = F.current_user() if user is None else user if isinstance(user, Column) else F.lit(user)
    ts = F.col("_copy_data_ts").cast("timestamp")
    a = raw.agg(F.count(F.lit(1)).alias("n"),
                F.count_if(~F.coalesce(ts.between(F.lit(started).cast("timestamp"), F.current_timestamp()), F.lit(False))).alias("late"),
                F.count_if(~F.col("_copy_data_user").eqNullSafe(user)).alias("others"),
                F.count_if(~F.col("_copy_data_role").eqNullSafe(F.lit(role))).alias("roles"))
    return a.select(F.inline(F.array(
        _row("Audit 1: Rows loaded", _pass(F.col("n") > 0, "WARN"), F.col("n")),
        _row("Audit 2: Load time within the run", _pass(F.col("late") == 0, "FAIL"), F.col("late")),
        _row("Audit 3: One user", _pass(F.col("others") == 0, "FAIL"), F.col("others")),
        _row("Audit 4: One role", _pass(F.col("roles") == 0, "FAIL"), F.col("roles")))))


def stage_metrics(raw: DataFrame, now=None) -> DataFrame:
    """A-12: raw row and distinct counts, first/last load, hours since the last load."""
    now_c = _now(now)
    a = raw.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("country").alias("unique_countries"),
        F.count_distinct("city").alias("unique_cities"),
        F.count_distinct("district").alias("unique_districts"),
        F.count_distinct("_stg_file_name").alias("unique_files"),
        F.min(F.col("_copy_data_ts").cast("timestamp_ntz")).alias("earliest_load"),
        F.max(F.col("_copy_data_ts").cast("timestamp_ntz")).alias("latest_load"))
    return a.withColumn("hours_since_last_load", boundary_diff("HOUR", F.col("latest_load"), now_c))


def stage_breakdown(raw: DataFrame, country: str | None = None) -> DataFrame:
    """A-13: rows and first/last load per country, city, district."""
    df = raw if country is None else raw.where(F.col("country") == country)
    return (df.groupBy("country", "city", "district")
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.min(F.col("_copy_data_ts").cast("timestamp_ntz")).alias("first_load"),
                 F.max(F.col("_copy_data_ts").cast("timestamp_ntz")).alias("last_load"))
            .orderBy(F.col("district").asc_nulls_last(), "country", "city"))


def clean_metrics(clean: DataFrame) -> DataFrame:
    """A-14: clean-table totals, distinct counts, time range and rounded averages."""
    return clean.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("measurement_ts").alias("unique_timestamps"),
        F.count_distinct("district").alias("unique_districts"),
        F.min("measurement_ts").alias("earliest_measurement"),
        F.max("measurement_ts").alias("latest_measurement"),
        round_avg("pm2_5", 2).alias("avg_pm2_5"),
        round_avg("us_epa_index", 2).alias("avg_epa_index"),
        round_avg("temp_c", 1).alias("avg_temperature"))


def district_summary(clean: DataFrame) -> DataFrame:
    """A-14: per-district counts, rounded averages and time range."""
    return (clean.groupBy("district")
            .agg(F.count(F.lit(1)).alias("measurement_count"),
                 round_avg("pm2_5", 2).alias("avg_pm2_5"),
                 round_avg("us_epa_index", 2).alias("avg_epa_index"),
                 F.min("measurement_ts").alias("first_measurement"),
                 F.max("measurement_ts").alias("last_measurement"))
            .orderBy(F.col("district").asc_nulls_last()))


def key_integrity(star: Star) -> DataFrame:
    """Q-12: key uniqueness of both dimensions and the fact, and fact-to-dimension references.

    Duplicate keys are reproduced, not repaired (D2 half-hour zones and DST give two facts per local hour; D6 shared
    coordinates give two locations per key); this check reports them. All keys go through one grouped pass: each table
    is read once, every key tagged with its space and with whether it owns or refers. A reference without an owner
    (or a NULL one) is an orphan.
    """
    key = lambda space, owns, c: F.struct(F.lit(space).alias("space"), F.lit(owns).alias("owns"), F.col(c).alias("key"))
    fact = star.fact.select(F.inline(F.array(key("fact", True, "aqi_pk"), key("date", False, "date_fk"), key("location", False, "location_fk"))))
    owned = star.date_dim.select(key("date", True, "date_pk").alias("k")).unionByName(star.location_dim.select(key("location", True, "location_pk").alias("k")))
    groups = (fact.unionByName(owned.select("k.space", "k.owns", "k.key")).groupBy("space", "key")
              .agg(F.count_if("owns").alias("owners"), F.count_if(~F.col("owns")).alias("references")))
    orphan = (F.col("owners") == 0) | F.col("key").isNull()
    of = lambda space, c: F.coalesce(F.sum(F.when(F.col("space") == space, c)), F.lit(0))
    twice = (F.col("owners") > 1).cast("long")
    a = groups.agg(*(of(s, twice).alias(f"{s}_dups") for s in ("date", "location", "fact")),
                   *(of(s, F.when(orphan, F.col("references")).otherwise(0)).alias(f"{s}_orphans") for s in ("date", "location")))
    rows = (("date_dim.date_pk unique", "date_dups"), ("location_dim.location_pk unique", "location_dups"), ("air_quality_fact.aqi_pk unique", "fact_dups"),
            ("air_quality_fact.date_fk -> date_dim", "date_orphans"), ("air_quality_fact.location_fk -> location_dim", "location_orphans"))
    return a.select(F.inline(F.array(*(_row(name, _pass(F.col(c) == 0, "FAIL"), F.col(c)) for name, c in rows))))


# Q-14: the rule set declared in the reference's configuration (nulls, duplicates, ranges).
NULL_RULE_FIELDS = ("measurement_epoch", "location_name", "latitude", "longitude")


ROW = "_row"


def scan_identity(df: DataFrame) -> DataFrame:
    """Rows of a table read from files with their place in it (file and row number), which no retry changes."""
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(ROW))


def _latest(*more: str) -> Column:
    """W-1's order as one value whose maximum is the latest: load time first, NULLs above all."""
    return F.struct(*(x for c in ORDER_COLUMNS for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))), *more)


def tag_validity(raw: DataFrame, check_nulls: bool = True, check_duplicates: bool = True,
                 check_ranges: bool = True) -> DataFrame:
    """Flattened readings with a ``reasons`` column ('' when valid); see ``split_valid``.

    Each dedup key has one winner, by W-1's order; every other reading of the key is a duplicate, identical copies
    included. With ``scan_identity`` rows, the winners of keys that occur twice come from a grouped maximum over key,
    order and place alone (combined on the map side, so a hot key sends one row a task) and are joined to the readings.
    Rows without a place are ranked in one window over whole readings instead.
    """
    flat = flatten_payload(raw, lenient=True, keep=(ROW,) if ROW in raw.columns else ())
    reasons = []
    if check_nulls:
        reasons.append(F.when(_any_null(NULL_RULE_FIELDS), F.lit("null")))
    if check_duplicates and ROW in raw.columns:
        keys = [f"w_{c}" for c in DEDUP_KEYS]
        winners = (flat.groupBy(*(F.col(c).alias(k) for c, k in zip(DEDUP_KEYS, keys))).agg(F.max(_latest(ROW)).alias("_winner"), F.count(F.lit(1)).alias("_copies"))
                   .where("_copies > 1").select(*keys, F.col(f"_winner.{ROW}").alias("_winner")))
        same = F.lit(True)
        for c, k in zip(DEDUP_KEYS, keys):
            same = same & F.col(c).eqNullSafe(F.col(k))
        flat = flat.join(winners, same, "left").drop(*keys)
        reasons.append(F.when(F.col("_winner").isNotNull() & (F.col("_winner") != F.col(ROW)), F.lit("duplicate")))
    elif check_duplicates:
        latest = Window.partitionBy(*DEDUP_KEYS).orderBy(*latest_file_order())
        flat = flat.withColumn("_winner", F.row_number().over(latest))
        reasons.append(F.when(F.col("_winner") > 1, F.lit("duplicate")))
    if check_ranges:
        reasons.append(F.when(range_violation(), F.lit("range")))
    tagged = flat.withColumn("reasons", F.concat_ws(",", *reasons) if reasons else F.lit(""))
    return tagged.drop(ROW, "_winner")


def split_valid(raw: DataFrame, **rules) -> tuple[DataFrame, DataFrame]:
    """Q-14: (accepted, rejected) readings; rejected rows carry their reasons.

    Values are read leniently (an uncastable value becomes NULL and fails the
    null rule instead of the query). A duplicate is any reading but the one that
    W-1 keeps for its dedup key, so as many are accepted as ``clean`` keeps.
    """
    tagged = tag_validity(raw, **rules)
    return tagged.where(F.col("reasons") == ""), tagged.where(F.col("reasons") != "")


def split_valid_report(raw: DataFrame) -> DataFrame:
    """Every reading with its validity and reasons (the registered form of Q-14)."""
    return tag_validity(raw).select("measurement_epoch", "location_name", "_stg_file_name", "reasons",
                                    (F.col("reasons") == "").alias("is_valid"))


def table_checks(spark, names=("raw_aqi", "clean_aqi_dt", "aqi_consumption_dt", "date_dim", "location_dim",
                               "air_quality_fact")):
    """Q-1 existence part: one row per expected table or view (catalog metadata, no data read)."""
    there = [(n, spark.catalog.tableExists(n)) for n in names]
    return spark.createDataFrame([(f"Exists: {n}", "PASS" if x else "FAIL", float(x)) for n, x in there], CHECK_SCHEMA)
