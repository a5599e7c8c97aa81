"""Incremental refresh with Structured Streaming (T-1..T-4, S-7, S-9).

One streaming query reads new landing files exactly once (the file source's checkpointed log is the load history). A
micro-batch lands and refreshes in two commits (``streaming.commits``):

1. **Land.** The raw rows go to ``raw_aqi/m_date=/batch_id=`` and the commit names the measurement hours they touch
   (observed while writing, no extra job).
2. **Refresh.** The new rows and the current clean rows of the touched hours are deduplicated together (latest file
   wins, which may be applied again to its own result), then the hourly rows and facts of these hours are computed and
   written to ``utc_date=/batch_id=`` folders of the batch. The commit makes the batch the current one of these hours;
   rows of an hour in older folders no longer count. Hours that were not touched are not written, however much history
   there is: a re-delivered hour rewrites its hour. Only folders of the touched dates are read, sorted by hour.
3. **Dimensions are counted distinct.** The batch writes how many hourly rows it added to or took from each dimension
   row; a dimension is what has a positive sum, so a row leaves when its count reaches 0, without reading the rest.

Every dedup key and every hourly group lies in one UTC hour (both contain the measurement epoch), so recomputing hours
is exact; late or re-delivered readings update published hours, without a cutoff. ``dropDuplicates`` would keep the
*first* copy, which is why it is not used.

Landing and refreshing may run apart (``run_incremental(refresh=False)``, then ``IncrementalMart.refresh`` on demand):
a refresh takes the raw batches after the last published one and does nothing, not even a commit, if there is none.

``compact`` merges the folders of a date, in every layer, and the dimension counts, and restates the log; ``vacuum`` removes folders
that are no longer live, and those of crashed batches, after a grace time. Both may run beside readers: a reader holds
the version it started with.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import ntz_from_epoch
from ..operators.clean import CLEAN_COLUMNS, DEDUP_KEYS, dedup_latest_file, flatten_payload
from ..operators.consumption import build_consumption
from ..operators.star import DATE_COLUMNS, LOCATION_COLUMNS, air_quality_fact, date_dim, location_dim
from ..plans.warehouse import UTC_DATE, Warehouse
from ..sources.landing import raw_from_text, split_malformed
from .commits import CommitLog, Version, hadoop_path

M_DATE, UTC_HOUR, BATCH = "m_date", "utc_hour", "batch_id"
MAX_FILES = 100_000  # files of a micro-batch, so a backfill of years is many bounded batches
COMPACT_EVERY = 32   # commits between two compactions
GRACE_SECONDS = 24 * 3600
NO_DATE = _dt.date(1900, 1, 1)  # the folder of readings without a measurement time (shared with what was measured then)
RAW_COLUMNS = ("raw", "country", "city", "district", "year", "month", "day", "_stg_file_name", "_stg_file_load_ts",
               "_stg_file_md5", "_copy_data_ts", "_copy_data_user", "_copy_data_role")
HOURLY_TABLES = ("clean_aqi", "aqi_consumption", "air_quality_fact")
# Dimension -> its columns in the hourly layer and the builder of its keys.
DIMENSIONS = {"date_dim": (("aqi_timestamp", *DATE_COLUMNS), date_dim), "location_dim": (LOCATION_COLUMNS, location_dim)}


def _date(ts) -> F.Column:
    return F.coalesce(F.to_date(ts), F.lit(NO_DATE))


def _hour(ts) -> F.Column:
    return F.coalesce(F.hour(ts), F.lit(0))


def measurement_ts(raw_col="raw") -> F.Column:
    return ntz_from_epoch(F.try_variant_get(F.col(raw_col), "$.current.last_updated_epoch", "decimal(38,0)"))


def _observed(hours: list | None) -> list:
    return sorted((_dt.date.fromisoformat(x[:10]), int(x[11:])) for x in hours or ())


HOURS = f"{UTC_DATE} date, {UTC_HOUR} int, {BATCH} int"


def _rows(hours: dict) -> list:
    return [(d, h, b) for (d, h), b in sorted(hours.items())]


class MartVersion(Warehouse):
    """Handles on the tables of one committed version."""

    def __init__(self, spark: SparkSession, root: str, version: Version):
        super().__init__(spark, root)
        self.version = version

    def table(self, name: str) -> DataFrame:
        df = self._tables.get(name)
        if df is None:
            df = self._tables[name] = self._read(name)
        return df

    def _live(self, name: str, rows: list, ddl: str) -> DataFrame:
        """The table's live rows: a semi join with rows of the log (so small), whose partition columns prune folders at run time."""
        live = self.spark.createDataFrame(rows, ddl)
        return self.spark.read.parquet(f"{self.root}/{name}").join(F.broadcast(live), live.columns, "left_semi")

    def _read(self, name: str) -> DataFrame:
        if name == "raw_aqi":
            return self._live(name, sorted(self.version.raw), f"{M_DATE} date, {BATCH} int").drop(M_DATE, BATCH)
        if name in DIMENSIONS:
            columns, build = DIMENSIONS[name]
            live = self._live(f"{name}_counts", [(b,) for b in sorted(self.version.dims)], f"{BATCH} int")
            return build(live.groupBy(*columns).agg(F.sum("n").alias("n")).where("n > 0"))
        return self._live(name, _rows(self.version.hours), HOURS)


def _several(folders) -> set:
    """The (date, batch) folders of dates that have more than one."""
    n = Counter(d for d, _ in folders)
    return {(d, b) for d, b in folders if n[d] > 1}


class IncrementalMart:
    """Tables of an incrementally maintained mart under ``root`` (one writer, any number of readers)."""

    def __init__(self, spark: SparkSession, root: str, arg_scale: int | None = None, compact_every: int = COMPACT_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.arg_scale = arg_scale
        self.compact_every = compact_every
        self.log = CommitLog(spark, self.path("commits"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def warehouse(self) -> MartVersion:
        """Handles on the current version; they keep it while later commits, compactions and vacuums run."""
        return MartVersion(self.spark, self.root, self.log.version())

    # ---- writing

    def _write(self, df: DataFrame, name: str, batch: int, ts: str, observe: Observation | None = None) -> None:
        """Rows by UTC date of ``ts`` into the folders of the batch; a retried batch replaces its own."""
        df = df.withColumns({UTC_DATE: _date(ts), UTC_HOUR: _hour(ts), BATCH: F.lit(int(batch))})
        if observe is not None:
            df = df.observe(observe, F.collect_set(F.concat_ws(" ", F.col(UTC_DATE).cast("string"), F.col(UTC_HOUR).cast("string"))).alias("hours"))
        self._put(df.hint("rebalance", UTC_DATE).sortWithinPartitions(UTC_DATE, UTC_HOUR), name, UTC_DATE)

    def _put(self, df: DataFrame, name: str, date: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date, BATCH).parquet(self.path(name)))

    def _leaves(self, name: str, date: str, folders) -> DataFrame:
        """(date, batch) folders, named one by one: no listing of the rest of the table."""
        leaves = [f"{self.path(name)}/{date}={d.isoformat()}/{BATCH}={b}" for d, b in sorted(folders)]
        return self.spark.read.option("basePath", self.path(name)).parquet(*leaves)

    def _hours(self, name: str, hours: dict) -> DataFrame | None:
        """The rows of (date, hour) -> batch."""
        if not hours:
            return None
        wanted = self.spark.createDataFrame(_rows(hours), HOURS)
        return self._leaves(name, UTC_DATE, {(d, b) for (d, _), b in hours.items()}).join(F.broadcast(wanted), wanted.columns, "left_semi")

    def append_raw(self, raw: DataFrame, txn: str) -> bool:
        """Land one batch of raw rows unless its transaction is committed already; False if there was nothing to do."""
        log = self.log.read()
        if any(r["txn"] == txn for r in log):
            return False
        seq = self.log.version(log).seq + 1
        obs, ts = Observation(), measurement_ts()
        out = (raw.select(*RAW_COLUMNS).withColumns({M_DATE: _date(ts), "_hour": _hour(ts), BATCH: F.lit(seq)})
               .observe(obs, F.collect_set(F.concat_ws(" ", F.col(M_DATE).cast("string"), F.col("_hour").cast("string"))).alias("hours")))
        self._put(out.drop("_hour").hint("rebalance", M_DATE), "raw_aqi", M_DATE)
        hours = _observed(obs.get.get("hours"))
        if not hours:
            return False
        self.log.commit(seq, txn, [("raw", d, h, seq, True) for d, h in hours])
        return True

    def refresh(self) -> int:
        """Bring the raw batches that are not published yet into all layers; the number of hours rewritten (0: nothing was
        stale, and nothing is written)."""
        log = self.log.read()
        now = self.log.version(log)
        pending = now.pending()
        if not pending:
            return 0
        seq, last = now.seq + 1, pending[-1]
        landed = {(r["utc_date"], r["batch"]) for r in log if r["kind"] == "raw" and r["batch"] in pending}
        touched = {(r["utc_date"], r["utc_hour"]) for r in log if r["kind"] == "raw" and r["batch"] in pending}
        raw = self._leaves("raw_aqi", M_DATE, landed)
        old = {k: b for k, b in now.hours.items() if k in touched}
        rows, held = flatten_payload(raw).select(*CLEAN_COLUMNS), self._hours("clean_aqi", old)
        obs = Observation()
        self._write(dedup_latest_file(rows if held is None else rows.unionByName(held.select(*CLEAN_COLUMNS))), "clean_aqi", seq, "measurement_ts", obs)
        new = {k: seq for k in _observed(obs.get.get("hours"))}
        done = [("published", None, None, last, True)]
        if new:
            clean = self._leaves("clean_aqi", UTC_DATE, {(d, seq) for d, _ in new}).select(*CLEAN_COLUMNS)
            self._write(build_consumption(clean, arg_scale=self.arg_scale), "aqi_consumption", seq, "aqi_timestamp_utc")
            cons = self._leaves("aqi_consumption", UTC_DATE, {(d, seq) for d, _ in new}).drop(UTC_DATE, UTC_HOUR, BATCH)
            self._write(air_quality_fact(cons), "air_quality_fact", seq, "utc_timestamp")
            self._count_dimensions(cons, self._hours("aqi_consumption", old), seq)
            done += [("hour", d, h, seq, True) for d, h in sorted(new)] + [("dim", None, None, seq, True)]
        self.log.commit(seq, f"refresh {last}", done)
        return len(new)

    def _count_dimensions(self, new: DataFrame, old: DataFrame | None, batch: int) -> None:
        """How many hourly rows the batch adds to and takes from each dimension row."""
        for name, (columns, _) in DIMENSIONS.items():
            rows = new.select(*columns, F.lit(1).alias("n"))
            if old is not None:
                rows = rows.unionByName(old.select(*columns, F.lit(-1).alias("n")))
            counts = rows.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")
            self._write_counts(counts, name, batch)

    def _write_counts(self, counts: DataFrame, name: str, batch: int) -> None:
        (counts.withColumn(BATCH, F.lit(int(batch))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH).parquet(self.path(f"{name}_counts")))

    def process_batch(self, batch: DataFrame, txn: str, refresh: bool = True) -> None:
        """``foreachBatch`` body: land, then refresh; every ``compact_every`` commits also compact and vacuum."""
        self.append_raw(batch, txn)
        if refresh:
            self.refresh()
            if self.log.version().since_snapshot >= self.compact_every:
                self.compact()
                self.vacuum()

    # ---- maintenance

    def compact(self) -> bool:
        """Merge the folders of each date, in raw and in the hourly layers, and the dimension counts, and restate the log. Does
        nothing while raw batches wait for a refresh. Readers see the version before until the one commit."""
        now = self.log.version()
        if now.pending() or not now.hours:
            return False
        seq, rows = now.seq + 1, []
        raw = _several(now.raw)
        if raw:
            merged = self._leaves("raw_aqi", M_DATE, raw).withColumn(BATCH, F.lit(seq)).hint("rebalance", M_DATE)
            self._put(merged, "raw_aqi", M_DATE)
            rows += [("raw", d, None, b, False) for d, b in raw] + [("raw", d, None, seq, True) for d in {d for d, _ in raw}]
        dates = {d for d, _ in _several({(d, b) for (d, _), b in now.hours.items()})}
        hours = {k: b for k, b in now.hours.items() if k[0] in dates}
        if hours:
            for name in HOURLY_TABLES:
                merged = self._hours(name, hours).withColumn(BATCH, F.lit(seq)).hint("rebalance", UTC_DATE)
                self._put(merged.sortWithinPartitions(UTC_DATE, UTC_HOUR), name, UTC_DATE)
            rows += [("hour", d, h, seq, True) for d, h in sorted(hours)]
        if len(now.dims) > 1:
            current = MartVersion(self.spark, self.root, now)
            for name, (columns, _) in DIMENSIONS.items():
                live = current._live(f"{name}_counts", [(b,) for b in sorted(now.dims)], f"{BATCH} int")
                self._write_counts(live.groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0"), name, seq)
            rows += [("dim", None, None, b, False) for b in now.dims] + [("dim", None, None, seq, True)]
        if rows:
            self.log.commit(seq, "compact", [*rows, ("published", None, None, seq, True)])
        self.log.snapshot(self.log.version())
        return bool(rows)

    def vacuum(self, grace_seconds: float = GRACE_SECONDS) -> int:
        """Remove folders that the current version does not name, and log files before the newest snapshot, once they are older
        than the grace time (the longest a reader may hold a version, or a batch may take). The number removed."""
        now, before = self.log.version(), (time.time() - grace_seconds) * 1000
        keep = {self.path("raw_aqi") + f"/{M_DATE}={d.isoformat()}/{BATCH}={b}" for d, b in now.raw}
        keep |= {f"{self.path(t)}/{UTC_DATE}={d.isoformat()}/{BATCH}={b}" for t in HOURLY_TABLES for (d, _), b in now.hours.items()}
        keep |= {f"{self.path(t)}_counts/{BATCH}={b}" for t in DIMENSIONS for b in now.dims}
        fs, root = hadoop_path(self.spark, self.root)
        base = fs.makeQualified(root).toString()
        keep = {base + p[len(self.root):] for p in keep}
        gone = 0
        patterns = [f"raw_aqi/{M_DATE}=*/{BATCH}=*", *(f"{t}/{UTC_DATE}=*/{BATCH}=*" for t in HOURLY_TABLES), *(f"{t}_counts/{BATCH}=*" for t in DIMENSIONS)]
        for pattern in patterns:
            for found in fs.globStatus(hadoop_path(self.spark, f"{self.root}/{pattern}")[1]) or ():
                if found.getPath().toString() not in keep and found.getModificationTime() <= before:
                    gone += bool(fs.delete(found.getPath(), True))
        for file in self.log.old_files():
            path = hadoop_path(self.spark, file)[1]
            if fs.getFileStatus(path).getModificationTime() <= before:
                gone += bool(fs.delete(path, False))
        return gone


def run_incremental(spark: SparkSession, landing_path: str, root: str, checkpoint: str, layout: str = "document",
                    role: str = "SYSADMIN", available_now: bool = True, processing_time: str = "30 minutes",
                    max_file_age: str = "36500d", max_files_per_trigger: int | None = MAX_FILES,
                    max_bytes_per_trigger: str | None = None, refresh: bool = True, compact_every: int = COMPACT_EVERY,
                    quarantine: bool = False):
    """T-1/T-2: one streaming query from landing files to the star schema.

    ``available_now`` processes every file present and stops (a scheduled refresh); otherwise the query runs with a
    processing-time trigger (the reference's 30-minute target lag). ``max_files_per_trigger`` (MAX_FILES unless given) /
    ``max_bytes_per_trigger`` bound each micro-batch, so a backfill of years of files runs as many bounded batches
    instead of one. ``refresh=False`` only lands (``IncrementalMart.refresh`` publishes on demand). A malformed document
    fails its batch; with ``quarantine`` its text goes to ``root/quarantine`` instead. Returns the started query.
    """
    mart = IncrementalMart(spark, root, compact_every=compact_every)
    reader = (spark.readStream.format("text").option("maxFileAge", max_file_age)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if layout == "document":
        reader = reader.option("wholetext", "true")
    text = reader.load(landing_path).select("value", "_metadata")

    def body(batch: DataFrame, batch_id: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        if quarantine:
            batch, broken = split_malformed(batch)
            (broken.withColumn(BATCH, F.lit(f"{query}-{batch_id}")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH).parquet(mart.path("quarantine")))
        mart.process_batch(batch.drop("_text", "_reason"), f"{query}-{batch_id}", refresh)

    raw = raw_from_text(text, role, lenient=quarantine, keep_text=quarantine)
    w = raw.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


# ---- T-4

def reading_stream(raw_stream: DataFrame) -> DataFrame:
    """The dedup key of each reading of a raw stream, with its time."""
    get = lambda path, t: F.try_variant_get(F.col("raw"), path, t)
    epoch = get("$.current.last_updated_epoch", "decimal(38,0)").cast("bigint")
    return raw_stream.select(ntz_from_epoch(epoch).cast("timestamp").alias("measurement_ts"), epoch.alias("measurement_epoch"),
                             get("$.location.name", "string").alias("location_name"), get("$.location.lat", "decimal(10,7)").alias("latitude"),
                             get("$.location.lon", "decimal(10,7)").alias("longitude"))


def hourly_window_stream(raw_stream: DataFrame, distinct: bool = False, watermark: str | None = None) -> DataFrame:
    """T-4 in-stream alternative: tumbling one-hour UTC windows of reading counts per location.

    Covers the UTC-hour key only (the local-hour key and latest-file-wins need the recompute above); for monitoring
    ingestion rates. With ``distinct`` a reading that is delivered again counts once: its key is kept in the stream's
    state. ``watermark`` (e.g. "2 days") drops state and readings that are older; without it nothing is dropped.
    """
    rows = reading_stream(raw_stream)
    if watermark:
        rows = rows.withWatermark("measurement_ts", watermark)
    if distinct:
        rows = rows.dropDuplicates(list(DEDUP_KEYS) + (["measurement_ts"] if watermark else []))
    return (rows.groupBy(F.window("measurement_ts", "1 hour"), "location_name")
            .agg(F.count(F.lit(1)).alias("readings")))


def run_hourly_counts(spark: SparkSession, landing_path: str, table: str, checkpoint: str, layout: str = "document",
                      role: str = "SYSADMIN", watermark: str | None = None, max_file_age: str = "36500d",
                      max_files_per_trigger: int = MAX_FILES):
    """T-4 as a job: windows counted in the state store, changed windows upserted (update mode).

    Each micro-batch writes the windows it changed to its own folder of ``table`` (a retried batch replaces it);
    ``hourly_counts`` reads the newest count of each window.
    """
    reader = (spark.readStream.format("text").option("maxFileAge", max_file_age).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", int(max_files_per_trigger)))
    if layout == "document":
        reader = reader.option("wholetext", "true")
    raw = raw_from_text(reader.load(landing_path).select("value", "_metadata"), role, lenient=False)
    counts = hourly_window_stream(raw, distinct=True, watermark=watermark)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("window.start").alias("utc_hour"), "location_name", "readings", F.lit(int(batch_id)).alias(BATCH))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(table))

    return (counts.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def hourly_counts(spark: SparkSession, table: str) -> DataFrame:
    """The newest count of each window that ``run_hourly_counts`` wrote."""
    return (spark.read.parquet(table).groupBy("utc_hour", "location_name")
            .agg(F.max_by("readings", BATCH).alias("readings")))
