"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from measured sizes
# (runtime broadcast of a small bot set, skew splitting of a hot IP) and
# coalesces small shuffle partitions; UTC keeps event times as sent.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "surgeflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, which
    has one machine, gets a folder of its own where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
        base = os.path.join(os.environ.get("TMPDIR", "/tmp"), "surgeflow-checkpoints")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a work folder, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder in the shared directory for one job's output."""
    return shared_dir(spark, "surgeflow", f"{name}-{uuid.uuid4().hex[:12]}")
