"""The bot rule over event-time windows, and the trailing message rate.

``window_verdicts`` is the stable counterpart of the micro-batch rule: an IP is
judged by its events in a window of event time, so that a verdict depends on no
micro-batch boundary. The same plan serves a table and a stream: on a stream with a
watermark it is a stateful aggregate per (window, IP) in append mode, and a verdict
comes out once, when the watermark closes its window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from surgeflow.config import DetectorConfig
from surgeflow.functions.columns import ntz, reason_text
from surgeflow.schema import EVENT_COLUMNS

WINDOW_KEY = ["w", "ip_address"]


def _window(col, seconds: int) -> Column:
    return F.window(col, f"{int(seconds)} seconds")


def window_verdicts(events: DataFrame, cfg: DetectorConfig, window_seconds: int = 60) -> DataFrame:
    """Per (window ``w``, IP): ``n``, ``threshold``, ``is_bot`` (n > rate * window,
    strict) and ``reason`` (of flagged pairs). The span of the rule is the window's
    length, at least the floor. Map-side combined: a hot IP costs one row a task."""
    span_us = max(int(window_seconds) * 1_000_000, cfg.floor_us)
    threshold = F.lit(cfg.rate_per_sec * (span_us / 1e6))
    counted = events.groupBy(_window("event_ts", window_seconds).alias("w"), "ip_address").agg(F.count(F.lit(1)).alias("n"))
    is_bot = F.col("n") > threshold
    return counted.select("w", "ip_address", "n", threshold.alias("threshold"), is_bot.alias("is_bot"),
                          F.when(is_bot, reason_text(cfg, F.lit(span_us).cast("long"))).alias("reason"))


def window_metrics(verdicts: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Per window: total, legitimate and flagged events, distinct and flagged IPs. On
    a stream this is a second stateful aggregate, behind the verdicts' own."""
    flagged = F.when(F.col("is_bot"), F.col("n")).otherwise(F.lit(0))
    sums = verdicts.groupBy(_window(F.window_time("w"), window_seconds).alias("w")).agg(
        F.sum("n").cast("long").alias("total_events"), F.sum(F.col("n") - flagged).cast("long").alias("legit_events"),
        F.sum(flagged).cast("long").alias("flagged_events"), F.count(F.lit(1)).alias("distinct_ips"),
        F.count_if("is_bot").alias("distinct_flagged_ips"))
    return shown(sums)


def window_flagged(events: DataFrame, verdicts: DataFrame, window_seconds: int = 60) -> DataFrame:
    """The events of flagged (window, IP) pairs with their reason. On a stream the join
    waits for the verdicts; its state goes when the watermark passes the window."""
    # the window alone carries the watermark into the join
    placed = events.select(*[ntz(c).alias(c) if c == "event_ts" else F.col(c) for c in EVENT_COLUMNS],
                           _window("event_ts", window_seconds).alias("w"))
    bots = verdicts.where("is_bot").select("w", "ip_address", "reason")
    return shown(placed.join(bots, WINDOW_KEY).select("w", *EVENT_COLUMNS, "reason"))


def shown(df: DataFrame) -> DataFrame:
    """``w`` as zone-less ``window_start`` and ``window_end``."""
    rest = [ntz(c).alias(c) if c == "event_ts" else F.col(c) for c in df.columns if c != "w"]
    return df.select(ntz(F.col("w.start")).alias("window_start"), ntz(F.col("w.end")).alias("window_end"), *rest)


CHUNK_SAMPLES = 1024


def trailing_rate(events: DataFrame, span_seconds: int = 60, every_seconds: int = 15,
                  chunk_samples: int = CHUNK_SAMPLES) -> DataFrame:
    """The rate as a dashboard shows it: at every ``every_seconds`` (from the first
    sample at or after the first event to the first that sees none any more) the
    messages of the ``span_seconds`` before it, the sample's own instant included;
    zeros where nothing came.

    An event raises the count at the first sample that sees it and lowers it at the
    first that does not any more. Steps are added up per sample, map-side first; an
    interval that reaches into another chunk of ``chunk_samples`` samples is cut
    there and raises the count again at the chunk's beginning, so that the running
    sum is one of each chunk: no window over all samples, whatever the range.
    """
    every, span, size = int(every_seconds) * 1_000_000, int(span_seconds) * 1_000_000, int(chunk_samples)
    us = F.unix_micros("event_ts")

    def sample_at(t: Column) -> Column:  # the first sample at or after a time
        return -F.floor(-t / F.lit(every))

    seen = (events.where("event_ts IS NOT NULL").select(sample_at(us).alias("up"), sample_at(us + F.lit(span)).alias("down"))
            .groupBy("up", "down").agg(F.count(F.lit(1)).alias("n")).where("up < down"))
    parts = seen.select("up", "down", "n", F.explode(F.sequence(F.floor(F.col("up") / size), F.floor((F.col("down") - 1) / size))).alias("chunk"))
    steps = parts.select("chunk", F.explode(F.array(
        F.struct(F.greatest("up", F.col("chunk") * size).alias("sample"), F.col("n").alias("step")),
        F.struct(F.col("down").alias("sample"), (-F.col("n")).alias("step")))).alias("s")).select("chunk", "s.*")
    steps = steps.where(F.col("sample") < (F.col("chunk") + 1) * size)  # a count ends with its chunk
    # every sample of the range, dealt by chunk before its samples are made
    ends = seen.agg(F.min("up").alias("lo"), F.max("down").alias("hi")).where("lo IS NOT NULL")
    chunks = ends.select("lo", "hi", F.explode(F.expr(f"sequence(floor(lo / {size}), floor(hi / {size}))")).alias("chunk")).repartition("chunk")
    grid = chunks.select("chunk", F.explode(F.sequence(F.greatest("lo", F.col("chunk") * size),
                                                       F.least("hi", (F.col("chunk") + 1) * size - 1))).alias("sample"),
                         F.lit(0).cast("long").alias("step"))
    level = (grid.unionByName(steps).groupBy("chunk", "sample").agg(F.sum("step").alias("step"))
             .withColumn("messages", F.sum("step").over(Window.partitionBy("chunk").orderBy("sample"))))
    return level.select(ntz(F.timestamp_micros(F.col("sample") * F.lit(every))).alias("sample_ts"), F.col("messages").cast("long").alias("messages"),
                        (F.col("messages") / F.lit(float(span_seconds))).alias("rate_per_sec"))
