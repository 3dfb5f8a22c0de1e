"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.session import scratch_dir

ROW_BITS = 33  # monotonically_increasing_id: row in the partition below, partition above


class Workspace:
    """Work tables of one job, in the shared folder the cluster names.

    Used as a context manager the tables are deleted on leaving; otherwise the
    caller calls ``drop`` once the results that read them are written. What is left
    when the application ends, results that were read lazily and the folders of
    failed runs, goes then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_dir(spark, name)
        self._tables: list[str] = []
        gone_at_exit(spark, self.root)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A table whose readers need no exchange to group or cogroup by ``key``."""
        table = "w_" + "".join(c if c.isalnum() else "_" for c in f"{self.root.rsplit('/', 1)[-1]}_{name}")
        (df.write.option("compression", "zstd").option("path", f"{self.root}/{name}")
         .bucketBy(buckets, key).saveAsTable(table))
        self._tables.append(table)
        return self.spark.table(table)

    def drop(self) -> None:
        for t in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.drop()


def gone_at_exit(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows go to Python workers by the thousand: whole texts are large rows, and a
    worker keeps the memory of its largest batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what made it may go."""
    return Workspace(df.sparkSession, name).write(df, "result")


def whole_text(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def global_rank(df: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with a gapless rank (long, from 0) in the order of ``keys``.

    One range exchange; the sorted rows are checkpointed, so that a row's place
    in its partition is settled, and the partitions' counts (a row each) give
    every partition its offset. Keep ``df`` narrow: it is written once.
    """
    spark = df.sparkSession
    cols = df.columns
    if not spark.sparkContext.getCheckpointDir():
        scratch_dir(spark, "rank")
    gone_at_exit(spark, spark.sparkContext.getCheckpointDir())  # the application's own folder
    ordered = (df.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
               .checkpoint().withColumn("_at", F.monotonically_increasing_id()))
    placed = ordered.select(*cols, F.shiftright("_at", ROW_BITS).alias("_part"),
                            F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"))
    # one entry a partition, as an array literal's size: bounded by the partition count
    counts = dict(placed.groupBy("_part").agg(F.count(F.lit(1))).collect())
    offsets, total = {}, 0
    for p in sorted(counts):
        offsets[p], total = total, total + counts[p]
    if not offsets:
        return placed.select(*cols, F.col("_row").alias(name))
    table = F.create_map(*[F.lit(x).cast("long") for kv in offsets.items() for x in kv])
    return placed.select(*cols, (table[F.col("_part")] + F.col("_row")).alias(name))
