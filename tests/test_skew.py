"""A hot IP holding a third of a batch: when the bot set is too large to
broadcast, AQE splits the hot key's partition in both split joins, and the
batch writer spreads a hot batch over several files."""

import contextlib
import glob
import os

from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig
from surgeflow.operators.detect import ip_rate, split_events
from surgeflow.sources.sinks import write_batches

SMALL_AQE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_batch(spark, n=60000, batches=1):
    ts = (F.lit("2026-01-01").cast("timestamp")
          + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 600).cast("decimal(18,6)")))
    return spark.range(n).select(
        F.format_string("e%d", "id").alias("event_id"), F.lit("u").alias("user_id"),
        F.lit("VIEW").alias("action"), F.lit("PRD-0001").alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit("198.51.100.1"))
         .otherwise(F.format_string("10.0.%d", F.col("id") % 4000)).alias("ip_address"),
        ts.alias("event_ts"), (F.col("id") % batches).cast("long").alias("batch_id"))


def test_hot_ip_partition_is_split(spark):
    with conf(spark, SMALL_AQE):
        ev = hot_batch(spark)
        clean, flagged = split_events(ev, ip_rate(ev, DetectorConfig(1.0, 5.0)))
        for df, n in ((flagged, 20000), (clean, 40000)):
            assert len(df.collect()) == n
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin(skew=true)" in plan, plan


def test_hot_batch_written_in_several_files(spark, tmp_path):
    ev = hot_batch(spark, n=60000, batches=3).withColumn(
        "batch_id", F.when(F.col("ip_address") == "198.51.100.1", F.lit(0)).otherwise(F.col("batch_id")))
    root = str(tmp_path / "t")
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        write_batches(ev.withColumn("reason", F.lit("r")), root, "events_flagged")
    files = glob.glob(os.path.join(root, "events_flagged", "batch_id=0", "*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(os.path.join(root, "events_flagged")).count() == 60000
