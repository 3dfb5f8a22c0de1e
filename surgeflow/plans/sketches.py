"""Summaries of single batches that merge over any set of batches.

Stored once per batch (``batch_summaries``), they answer for a range of batches
without its events: distinct IPs by a union of HyperLogLog sketches, quantiles of
the wait for the batch's end by merged KLL sketches, and the candidates for heavy
hitters by bounded counters. The exact answer stands beside each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14  # 2^14 registers: standard error about 0.8 %
KLL_K = 800  # rank error about 0.3 % at 99 % confidence
COUNTERS = 500
QUANTILES = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def with_wait(events: DataFrame, spans: DataFrame) -> DataFrame:
    """Events with ``wait_ms``: from the event to the last one of its batch (``spans``:
    batch_id, max_ts), the least time it waits for its batch to be cut."""
    us = F.unix_micros("max_ts") - F.unix_micros("event_ts")
    return events.join(spans.select("batch_id", "max_ts"), "batch_id").withColumn("wait_ms", F.floor(us / 1000).cast("long")).drop("max_ts")


def batch_summaries(waits: DataFrame, counts: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """A row per batch: ``events``, ``ips`` and ``waits`` (sketches), ``heavy`` (the IPs
    with at least events / ``counters`` of the batch's events, so at most that many).

    ``waits``: events with ``wait_ms``; ``counts``: events per (batch_id, ip_address).
    """
    from_counts = counts.groupBy("batch_id").agg(F.sum("n").cast("long").alias("events"), F.hll_sketch_agg("ip_address", LG_K).alias("ips"))
    kll = waits.groupBy("batch_id").agg(F.kll_sketch_agg_bigint("wait_ms", F.lit(KLL_K)).alias("waits"))
    total = counts.groupBy("batch_id").agg(F.sum("n").alias("events"))
    heavy = (counts.join(total, "batch_id").where(F.col("n") * counters >= F.col("events"))
             .groupBy("batch_id").agg(F.collect_list("ip_address").alias("heavy")))
    return from_counts.join(kll, "batch_id", "left").join(heavy, "batch_id", "left")


def distinct_estimate(summaries: DataFrame, group: Column) -> DataFrame:
    """(range, estimate): distinct IPs over the batches of each range."""
    return summaries.groupBy(group.alias("range")).agg(F.hll_sketch_estimate(F.hll_union_agg("ips")).alias("estimate"))


def distinct_exact(counts: DataFrame, group: Column) -> DataFrame:
    """(range, distinct_ips) from the per-(batch, IP) rows, which are far fewer than events."""
    return counts.select(group.alias("range"), "ip_address").distinct().groupBy("range").agg(F.count(F.lit(1)).alias("distinct_ips"))


def quantile_estimates(summaries: DataFrame, group: Column) -> DataFrame:
    """(range, one column per quantile) from the merged sketches."""
    merged = summaries.groupBy(group.alias("range")).agg(F.kll_merge_agg_bigint("waits").alias("s"))
    return merged.select("range", *[F.kll_sketch_get_quantile_bigint("s", F.lit(q)).alias(name) for name, q in QUANTILES.items()])


def quantiles_exact(waits: DataFrame, group: Column) -> DataFrame:
    """The same columns, exactly: the least wait that the share of events does not exceed."""
    return waits.groupBy(group.alias("range")).agg(
        *[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY wait_ms)").cast("long").alias(name) for name, q in QUANTILES.items()])


def heavy_hitters(counts: DataFrame, summaries: DataFrame, k: int = 10, counters: int = COUNTERS) -> DataFrame:
    """The k IPs of the most events over the batches of ``summaries``, exactly: ``ip_address``,
    ``events``, ``batches``; ties by IP.

    An IP that no batch's summary holds has fewer than events / ``counters`` in each
    batch, so fewer than that share of all: only those that some summary holds are
    counted again, by one semi-joined pass. Where the k-th of them does not reach
    that share, others could, and all IPs are counted.
    """
    batches = summaries.select("batch_id")
    candidates = summaries.select(F.explode("heavy").alias("ip_address")).distinct()

    def counted(rows: DataFrame) -> DataFrame:
        return (rows.join(batches, "batch_id", "left_semi").groupBy("ip_address")
                .agg(F.sum("n").cast("long").alias("events"), F.count(F.lit(1)).alias("batches"))
                .orderBy(F.desc("events"), "ip_address").limit(k))

    few = counted(counts.join(candidates, "ip_address", "left_semi"))
    least = few.agg(F.count(F.lit(1)).alias("k"), F.min("events").alias("least")).first()
    total = summaries.agg(F.sum("events")).first()[0] or 0
    return few if least["k"] == k and least["least"] * counters >= total else counted(counts)
