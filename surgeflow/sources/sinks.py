"""Sinks: per-batch Parquet directories (replay-safe) and a JDBC append.

Each writer replaces exactly one batch's directory, so running a batch twice
leaves one copy, and a replay with no rows still clears what an earlier run
wrote. Multi-batch writers use dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import InheritableThread

from surgeflow.schema import CLEAN_COLUMNS, EVENT_COLUMNS, FLAGGED_COLUMNS, METRIC_COLUMNS
from surgeflow.functions.columns import ntz
from surgeflow.sources.tables import batch_path, committed_batches, delete_path, path_exists, read_table, table_path

TABLE_COLUMNS = {
    "events_clean": CLEAN_COLUMNS,
    "events_flagged": FLAGGED_COLUMNS,
    "events_agg": ["window_start", "product_id", "action", "event_count", "batch_id"],
    "pipeline_metrics": METRIC_COLUMNS,
    "dead_letter": [*EVENT_COLUMNS, "raw", "error", "batch_id"],
}
STAMP_COLUMN = {"events_clean": "ingested_at", "events_flagged": "ingested_at",
                "pipeline_metrics": "created_at"}


def _prepared(df: DataFrame, table: str) -> DataFrame:
    out = df.select(*TABLE_COLUMNS[table])
    stamp = STAMP_COLUMN.get(table)
    if stamp:
        out = out.withColumn(stamp, F.current_timestamp())
    return out


def write_partition(df: DataFrame, root: str, table: str, batch_id: int,
                    sort_by: list[str] | None = None, observed: Observation | None = None) -> None:
    """Replace one batch's directory of ``table`` with ``df`` (fixed column
    list; ``batch_id`` lives in the directory name). Sorting within files by
    event time keeps Parquet min/max statistics useful for time filters."""
    # One batch: the file count is already bounded by the input splits (a
    # broadcast split join keeps them) or by AQE's coalesced shuffle
    # partitions, so no extra shuffle is spent on file sizing here.
    out = _prepared(df, table).drop("batch_id")
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    if observed:  # in the writing tasks themselves, which count once whatever is tried again
        out = out.observe(observed, F.count(F.lit(1)).alias("written_rows"), F.min("event_ts").alias("first_event"),
                          F.max("event_ts").alias("last_event"))
    out.write.mode("overwrite").parquet(batch_path(root, table, batch_id))


def write_batches(df: DataFrame, root: str, table: str, sort_by: list[str] | None = None) -> None:
    """Write many batches at once, replacing only the batches present in ``df``.

    Rows are rebalanced on ``batch_id`` first, so each batch lands in few
    files; AQE splits a batch that holds a large share of the rows across
    several tasks instead of one.
    """
    out = _prepared(df, table).hint("rebalance", "batch_id")
    if sort_by:
        out = out.sortWithinPartitions("batch_id", *sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(table_path(root, table)))


def clear_batch(spark: SparkSession, root: str, table: str, batch_id: int) -> None:
    delete_path(spark, batch_path(root, table, batch_id))


def write_agg_delta(df: DataFrame, root: str, batch_id: int) -> None:
    """Keyed additive upsert, write side: this batch's (window_start,
    product_id, action, event_count) delta replaces its own directory."""
    write_partition(df, root, "events_agg", batch_id)


def write_batch_metrics(df: DataFrame, root: str, batch_id: int) -> None:
    """The one metrics row of a non-empty batch; written last (commit mark)."""
    write_partition(df.coalesce(1), root, "pipeline_metrics", batch_id)


REPORT_SCHEMA = "table_name string, written_rows long, first_event timestamp, last_event timestamp"


def write_report(spark: SparkSession, root: str, batch_id: int, seen: dict[str, dict]) -> None:
    """What the write jobs of a batch observed, a row per table; before the commit mark."""
    rows = [(t, m["written_rows"], m["first_event"], m["last_event"]) for t, m in sorted(seen.items())]
    spark.createDataFrame(rows, REPORT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(batch_path(root, "write_report", batch_id))


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """The reports of committed batches."""
    path, schema = table_path(root, "write_report"), f"{REPORT_SCHEMA}, batch_id long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).join(committed_batches(spark, root), "batch_id", "left_semi")


def reconcile_written(spark: SparkSession, root: str) -> DataFrame:
    """Per committed batch and table: rows and event-time bounds as the write job saw
    them, the rows that the table holds, and whether all agree."""
    stored = None
    for table in ("events_clean", "events_flagged"):
        part = read_table(spark, root, table).groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("stored_rows"), F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"))
        part = part.withColumn("table_name", F.lit(table))
        stored = part if stored is None else stored.unionByName(part)
    both = read_report(spark, root).join(stored, ["batch_id", "table_name"], "full_outer")
    zero = F.lit(0).cast("long")
    same = (F.col("written_rows").eqNullSafe(F.coalesce("stored_rows", zero)) & F.col("first_event").eqNullSafe(F.col("lo"))
            & F.col("last_event").eqNullSafe(F.col("hi")))
    return both.select("batch_id", "table_name", "written_rows", ntz("first_event").alias("first_event"), ntz("last_event").alias("last_event"),
                       F.coalesce("stored_rows", zero).alias("stored_rows"), same.alias("same"))


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> bool:
    """Append to a JDBC table, skipped when ``df`` is empty. One connection
    per partition, one transaction per task. Returns whether it wrote."""
    if df.isEmpty():
        return False
    df.write.mode("append").jdbc(url=url, table=table, properties=properties)
    return True


def run_writes(writes: list[Callable[[], None]], parallel: bool = True) -> None:
    """Run independent writes, as concurrent Spark jobs when ``parallel``.

    Each write is mostly planning and commit latency on the driver plus its
    own tasks, so overlapping them fills the cluster better than a queue. The
    threads inherit the caller's local properties (scheduler pool, job group,
    the streaming batch they belong to). All writes finish before the first
    failure is re-raised, so a caller that writes its commit mark afterwards
    never marks a partial batch.
    """
    if not parallel or len(writes) <= 1:
        for fn in writes:
            fn()
        return
    errors: list[BaseException] = []

    def guarded(fn):
        def go():
            try:
                fn()
            except BaseException as e:  # re-raised in the caller below
                errors.append(e)
        return go

    threads = [InheritableThread(target=guarded(fn)) for fn in writes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
