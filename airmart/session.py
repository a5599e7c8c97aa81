"""Session settings and the shared folder for materialized tables.

Every function in the library is a DataFrame -> DataFrame transformation; the
only things it needs from the session are a UTC session time zone (audit
columns are LTZ timestamps), AQE, dynamic partition overwrite for the
incremental rebuild, and a shared folder (``spark.checkpoint.dir``) where
materialized layers are written so that lineage is cut and lost executors do
not force a recompute from the landing files.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # MODE keeps one small map per group; below this many groups a task aggregates without sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "airmart", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let the launcher decide; shuffle
    partitions then stay at the cluster setting and AQE coalesces them.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"):
        spark.conf.set(k, conf[k])
    return spark


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 << 20, input_per_shuffle_partition: int = 1 << 30) -> dict:
    """Settings sized for a large input (e.g. 100 TB of landing JSON on 1,000 executors).

    * scan splits of ``target_partition_bytes`` (``files.maxPartitionBytes``),
    * an initial shuffle width of one partition per GB of input (projection and
      map-side partial aggregation shrink what is shuffled), never below 3x the
      task slots; AQE then coalesces to the advisory size,
    * skew handling on: a partition more than 5x the median and over 1 GB is
      split (joins) and ``rebalance`` writes split hot output partitions.
    Apply at session build time (``get_session(extra=cluster_settings(...))``).
    """
    slots = executors * cores_per_executor
    initial = max(3 * slots, -(-input_bytes // input_per_shuffle_partition))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": SESSION_DEFAULTS[
            "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"],
    }


def shared_root(spark: SparkSession) -> str:
    """Folder for materialized tables: the cluster's ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests, bench) do
    we create a folder of our own; on a cluster a missing setting is an error,
    because a machine-local folder would not survive executor loss.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="airmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_table_root(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared root for one build."""
    return f"{shared_root(spark)}/airmart/{label}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "shared_root", "new_table_root", "cluster_settings", "SESSION_DEFAULTS"]
