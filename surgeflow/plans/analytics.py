"""The analytical questions asked of the four tables, as DataFrame plans.

Inputs are the stored schemas: ``agg`` = (window_start, product_id, action,
event_count), ``metrics`` = pipeline_metrics, ``flagged`` = events_flagged.
Time columns are returned zone-less (``timestamp_ntz``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeflow.functions.columns import ntz, safe_pct


def top_products(agg: DataFrame, k: int = 10) -> DataFrame:
    """Top k (product, action) by summed event_count; ties broken by key so
    the cut is deterministic. Partial sums before the shuffle; the top-k is a
    TakeOrderedAndProject, no global sort."""
    return (agg.groupBy("product_id", "action")
            .agg(F.sum("event_count").cast("long").alias("total"))
            .orderBy(F.desc("total"), "product_id", "action").limit(k))


def throughput(metrics: DataFrame) -> DataFrame:
    """Events per batch (total / legit / flagged) in time order."""
    return (metrics.select(ntz("batch_ts").alias("batch_ts"), "total_events", "legit_events",
                           "flagged_events", "batch_id")
            .orderBy("batch_ts", "batch_id").drop("batch_id"))


def flagged_pct(metrics: DataFrame) -> DataFrame:
    """Overall legit total, flagged total and flagged share in percent."""
    return metrics.agg(
        F.sum("legit_events").cast("long").alias("legit_total"),
        F.sum("flagged_events").cast("long").alias("flagged_total"),
        safe_pct(F.sum("flagged_events"), F.sum("total_events")).alias("flagged_pct"))


def top_offenders(flagged: DataFrame, k: int = 10) -> DataFrame:
    """IPs with the most flagged rows and the number of batches they were
    flagged in; ties broken by IP."""
    return (flagged.groupBy("ip_address")
            .agg(F.count(F.lit(1)).alias("flagged_event_count"),
                 F.countDistinct("batch_id").alias("batches_flagged_in"))
            .orderBy(F.desc("flagged_event_count"), "ip_address").limit(k))


def latency_distribution(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.min("processing_time_ms").alias("min_ms"),
        F.round(F.avg("processing_time_ms"), 1).alias("avg_ms"),
        F.max("processing_time_ms").alias("max_ms"),
        F.count(F.lit(1)).alias("batch_count"))


def minute_rollup(metrics: DataFrame) -> DataFrame:
    """Events per minute of batch time, in minute order."""
    return (metrics.groupBy(F.date_trunc("minute", "batch_ts").alias("minute"))
            .agg(F.sum("total_events").cast("long").alias("events_in_minute"))
            .orderBy("minute").select(ntz("minute").alias("minute"), "events_in_minute"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, UNION ALL (bag semantics)."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def verdict_counts(keyed: DataFrame, metrics: DataFrame) -> DataFrame:
    """``table_counts`` from one pass: ``keyed`` holds clean and flagged rows per
    aggregate key, a row of ``events_agg`` where any is clean."""
    sums = keyed.agg(F.coalesce(F.sum("clean_rows"), F.lit(0)).alias("events_clean"),
                     F.coalesce(F.sum("flagged_rows"), F.lit(0)).alias("events_flagged"),
                     F.count_if(F.col("clean_rows") > 0).alias("events_agg"))
    rows = sums.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("table_name"), F.col(t).cast("long").alias("row_count")) for t in sums.columns])).alias("r"))
    return rows.select("r.table_name", "r.row_count").unionByName(table_counts({"pipeline_metrics": metrics}))


def latest_batches(metrics: DataFrame, k: int = 5) -> DataFrame:
    return (metrics.orderBy(F.desc("batch_ts"), F.desc("batch_id")).limit(k)
            .select("batch_id", ntz("batch_ts").alias("batch_ts"), "total_events", "legit_events",
                    "flagged_events", "processing_time_ms"))


def latency_series(metrics: DataFrame) -> DataFrame:
    return (metrics.select(ntz("batch_ts").alias("time"), F.col("processing_time_ms").alias("ms"),
                           "batch_id")
            .orderBy("time", "batch_id").drop("batch_id"))


def flagged_ip_series(metrics: DataFrame) -> DataFrame:
    return (metrics.select(ntz("batch_ts").alias("time"),
                           F.col("distinct_flagged_ips").alias("bot_ips"),
                           F.col("distinct_ips").alias("total_ips"), "batch_id")
            .orderBy("time", "batch_id").drop("batch_id"))


def message_rate(events: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Messages per event-time window and the per-second rate in it.

    On a stream, apply after ``withWatermark`` and write in append mode; each
    window is emitted once when the watermark passes its end.
    """
    w = F.window("event_ts", f"{int(window_seconds)} seconds")
    return (events.groupBy(w.alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .select(ntz(F.col("w.start")).alias("window_start"), ntz(F.col("w.end")).alias("window_end"),
                    "messages",
                    (F.col("messages") / F.lit(float(window_seconds))).alias("rate_per_sec")))
