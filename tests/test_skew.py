"""Hot keys: one location re-delivered many times must still dedup to the latest file exactly."""

from pyspark.sql import functions as F

from airmart.operators.clean import CLEAN_COLUMNS, clean
from airmart.operators.consumption import build_consumption
from airmart.operators.quality import split_valid_report
from airmart.plans.registry import warehouse_for
from tests.conftest import SF_SMALL

PAYLOAD = [c for c in CLEAN_COLUMNS if not c.startswith("_")]


def test_hot_location_redelivered(spark):
    raw = warehouse_for(spark, SF_SMALL).raw
    hot = raw.where(F.col("district") == "santa_anita")
    n_hot = hot.count()
    # 30 re-deliveries of one location's readings: that location now holds most of the rows.
    copies = spark.range(1, 31).withColumnRenamed("id", "copy")
    redelivered = (hot.crossJoin(copies)
                   .withColumn("_stg_file_load_ts", F.col("_stg_file_load_ts") + F.make_dt_interval(F.col("copy")))
                   .drop("copy"))
    skewed = raw.unionByName(redelivered).repartition(11)
    assert skewed.count() == raw.count() + 30 * n_hot
    a = clean(raw).select(*PAYLOAD)
    b = clean(skewed).select(*PAYLOAD)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    cons_a = build_consumption(clean(raw)).drop("_stg_file_load_ts", "_copy_data_ts")
    cons_b = build_consumption(clean(skewed)).drop("_stg_file_load_ts", "_copy_data_ts")
    assert cons_a.exceptAll(cons_b).count() == 0 and cons_b.exceptAll(cons_a).count() == 0
    report = split_valid_report(skewed)
    dup = report.where(F.col("reasons").contains("duplicate")).count()
    assert dup == skewed.count() - clean(skewed).count()


def test_hourly_window_stream(spark, tmp_dir):
    from airmart.sources.landing import raw_from_text, write_landing
    from airmart.streaming.incremental import hourly_window_stream
    raw = warehouse_for(spark, SF_SMALL).raw
    write_landing(raw, f"{tmp_dir}/land")
    stream = (spark.readStream.format("text").option("recursiveFileLookup", "true").option("maxFileAge", "36500d")
              .load(f"{tmp_dir}/land").select("value", "_metadata"))
    counts = hourly_window_stream(raw_from_text(stream, "SYSADMIN", lenient=False))
    q = (counts.writeStream.format("memory").queryName("hourly_counts").outputMode("complete")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.sql("SELECT sum(readings) AS n FROM hourly_counts").first().n
    assert total == raw.count()
