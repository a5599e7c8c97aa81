"""Commit log of an incrementally maintained mart.

Data folders are written first and named in one small file afterwards; that file is the commit. Folders that no commit
names are invisible, so a crash between the two leaves the old version. A row says that in commit ``seq`` (of the
transaction ``txn``) the folder of ``batch`` became the current one:

* ``raw``: landed readings of a measurement hour; a date has one live folder per batch until they are merged;
* ``hour``: the clean, hourly and fact rows of one UTC hour (the newest batch of an hour is its only live one);
* ``dim``: counts of dimension rows that a batch added or took away;
* ``published``: every raw batch up to this one has reached the hourly layers.

A ``snapshot`` restates all that is live, so readers start at the newest one. The log holds rows per UTC hour of the
calendar (8,760 a year), not per reading or location, which bounds what the driver reads of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "seq long, txn string, kind string, utc_date date, utc_hour int, batch long, live boolean, at timestamp"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder in whatever store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


@dataclass(frozen=True)
class Version:
    """What is live after commit ``seq``: ``hours`` (date, hour) -> batch, ``raw`` (date, batch), ``dims`` batches, the last
    published raw batch and the transaction that landed last."""

    seq: int
    txn: str
    hours: dict
    raw: frozenset
    dims: frozenset
    published: int
    since_snapshot: int

    def pending(self) -> list:
        """Raw batches that landed after the last published one."""
        return sorted({b for _, b in self.raw if b > self.published})


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        fs, p = hadoop_path(self.spark, self.path)
        if not fs.exists(p):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)

    def read(self) -> list:
        """The rows from the newest snapshot on, in order."""
        rows = self.rows()
        first = rows.where("kind = 'snapshot'").agg(F.coalesce(F.max("seq"), F.lit(0))).scalar()
        kept = rows.where(F.col("seq") >= first).select("seq", "txn", "kind", "utc_date", "utc_hour", "batch", "live").collect()
        return sorted(kept, key=lambda r: r["seq"])

    def version(self, log: list | None = None) -> Version:
        hours, raw, dims, published, seq, snapshot, txn = {}, set(), set(), -1, 0, 0, ""
        for r in self.read() if log is None else log:
            seq = r["seq"]
            if r["kind"] == "hour":
                hours[r["utc_date"], r["utc_hour"]] = r["batch"]
            elif r["kind"] == "published":
                published = max(published, r["batch"])
            elif r["kind"] == "snapshot":
                snapshot, txn = seq, r["txn"]
            else:
                txn = r["txn"] if r["utc_hour"] is not None else txn  # only landed rows have an hour
                held, key = (raw, (r["utc_date"], r["batch"])) if r["kind"] == "raw" else (dims, r["batch"])
                held.add(key) if r["live"] else held.discard(key)
        return Version(seq, txn, hours, frozenset(raw), frozenset(dims), published, seq - snapshot)

    def commit(self, seq: int, txn: str, rows: list) -> None:
        """One file with the rows (kind, date, hour, batch, live): it is there as a whole or not at all."""
        df = self.spark.createDataFrame([(seq, txn, *r) for r in rows], LOG_SCHEMA.rsplit(",", 1)[0])
        df.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def snapshot(self, v: Version) -> None:
        """Restate the live rows of ``v`` in one commit."""
        seq = v.seq + 1
        rows = [("snapshot", None, None, seq, True), ("published", None, None, v.published, True)]
        rows += [("hour", d, h, b, True) for (d, h), b in v.hours.items()]
        rows += [("raw", d, None, b, True) for d, b in v.raw] + [("dim", None, None, b, True) for b in v.dims]
        self.commit(seq, v.txn, rows)  # the last landed transaction stays known: its batch may be tried again

    def old_files(self) -> list:
        """Files of the log that only hold rows before the newest snapshot."""
        rows = self.rows()
        first = rows.where("kind = 'snapshot'").agg(F.coalesce(F.max("seq"), F.lit(0))).scalar()
        files = rows.groupBy(F.input_file_name().alias("file")).agg(F.max("seq").alias("seq")).where(F.col("seq") < first)
        return [r["file"] for r in files.collect()]
