"""Rate-based bot separation, expressed as DataFrame -> DataFrame functions.

Every function keys on a ``batch_id`` column, so one implementation serves a
single micro-batch (constant id) and a whole history of batches at once.

Plan shape (the events are read by one narrow aggregate and one join):

    events --partial count/min/max--> Exchange(batch_id, ip) --> per (batch, IP) n, bounds
        (written out once where several questions follow)
    per (batch, IP) --partial--> Exchange(batch_id)          --> per batch span
    per (batch, IP) JOIN per batch span ON batch_id, salt    --> rates, is_bot
    events LEFT (bot pairs) ON (batch_id, ip)                --> events with their verdict

The bot set is never collected to the driver and no broadcast is forced on it:
AQE measures the materialised set and broadcasts it when small, and otherwise
keeps a sort-merge join whose hot-IP partition it splits (skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig
from surgeflow.functions.columns import (effective_span_us, raw_span_us, reason_text,
                                         reusable, span_seconds)
from surgeflow.schema import CLEAN_COLUMNS, FLAGGED_COLUMNS

PAIR_KEY = ["batch_id", "ip_address"]
SALTS = 16


@reusable
def _salt() -> Column:
    return F.pmod(F.hash("ip_address"), F.lit(SALTS))


@reusable
def _salts() -> Column:
    return F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")


@reusable
def _pair_aggs() -> tuple[Column, ...]:
    return (F.count(F.lit(1)).alias("n"), F.min("event_ts").alias("min_ts"), F.max("event_ts").alias("max_ts"))


@reusable
def _span_aggs() -> tuple[Column, ...]:
    return (F.sum("n").cast("long").alias("total_events"), F.min("min_ts").alias("min_ts"),
            F.max("max_ts").alias("max_ts"))


@reusable
def _span_columns(cfg: DetectorConfig) -> tuple[Column, ...]:
    span_us = effective_span_us("min_ts", "max_ts", cfg)
    span_sec = span_seconds(span_us)
    return (span_seconds(raw_span_us("min_ts", "max_ts")).alias("raw_span_sec"),
            span_us.alias("span_us"), span_sec.alias("span_sec"),
            (F.lit(float(cfg.rate_per_sec)) * span_sec).alias("threshold"),
            reason_text(cfg, span_us).alias("reason"))


@reusable
def _is_bot() -> Column:
    return (F.col("n") > F.col("threshold")).alias("is_bot")


def ip_counts(events: DataFrame) -> DataFrame:
    """(batch_id, ip_address, n, min_ts, max_ts): map-side combined, so a hot IP
    costs one partial row per task before the shuffle, not all its events."""
    return events.groupBy(*PAIR_KEY).agg(*_pair_aggs())


def batch_span(events: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Per batch: total events, event-time bounds, raw and effective span.

    Columns: batch_id, total_events, min_ts, max_ts, raw_span_sec, span_us,
    span_sec, threshold, reason. Rolled up from the per-IP counts, partially
    per task, so that a batch of very many IPs meets in one row per task.
    """
    return spans_of(ip_counts(events), cfg)


def spans_of(counts: DataFrame, cfg: DetectorConfig) -> DataFrame:
    per_batch = counts.groupBy("batch_id").agg(*_span_aggs())
    return per_batch.select("batch_id", "total_events", "min_ts", "max_ts", *_span_columns(cfg))


def ip_rate(events: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Per (batch, IP): n, span_sec, threshold, is_bot (n > threshold, strict), reason."""
    return rates_of(ip_counts(events), cfg)


def rates_of(counts: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """``ip_rate`` from ``ip_counts``. The two sides of its join need different
    columns, so a lazy plan derives the counts for each; a caller that uses the
    rates several times writes the counts out first.

    A batch's IPs are dealt over ``SALTS`` join keys, and its one span row repeated
    for each: joined on the batch alone, one huge batch would be one task here and,
    as the rows lie by batch then, in every aggregate per batch that follows."""
    spans = spans_of(counts, cfg).select("batch_id", "span_sec", "threshold", "reason", _salts())
    return (counts.withColumn("salt", _salt()).join(spans, ["batch_id", "salt"])
            .select("batch_id", "ip_address", "n", "span_sec", "threshold", _is_bot(), "reason"))


def bot_pairs(rates: DataFrame) -> DataFrame:
    """(batch_id, ip_address, reason) of the flagged pairs."""
    return rates.filter("is_bot").select("batch_id", "ip_address", "reason")


def flag_reason(rates: DataFrame) -> DataFrame:
    return bot_pairs(rates)


def with_verdict(events: DataFrame, rates: DataFrame) -> DataFrame:
    """Events with ``reason``: that of their flagged (batch, IP), NULL for clean rows.

    One left join on the unique pair key. An empty bot set leaves every row
    clean without a branch. NULL IPs are removed by validation before.
    """
    return events.join(bot_pairs(rates), PAIR_KEY, "left").select(*FLAGGED_COLUMNS)


def clean_of(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter("reason IS NULL").select(*CLEAN_COLUMNS)


def flagged_of(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter("reason IS NOT NULL").select(*FLAGGED_COLUMNS)


def split_events(events: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, flagged). Every row of a flagged (batch, IP) is flagged."""
    verdicts = with_verdict(events, rates)
    return clean_of(verdicts), flagged_of(verdicts)


@reusable
def _metric_aggs() -> tuple[Column, ...]:
    flagged_n = F.when(F.col("is_bot"), F.col("n")).otherwise(F.lit(0))
    return (F.sum("n").cast("long").alias("total_events"),
            F.sum(flagged_n).cast("long").alias("flagged_events"),
            F.count(F.lit(1)).alias("distinct_ips"),
            F.count(F.when(F.col("is_bot"), F.lit(1))).alias("distinct_flagged_ips"))


@reusable
def _legit() -> Column:
    return (F.col("total_events") - F.col("flagged_events")).alias("legit_events")


def batch_metrics(rates: DataFrame) -> DataFrame:
    """One row per non-empty batch, from the per-IP rates alone (no second
    pass over the events): total, legit (by subtraction), flagged, distinct
    IPs and distinct flagged IPs. Clock fields are added by the caller."""
    return (rates.groupBy("batch_id").agg(*_metric_aggs())
            .select("batch_id", "total_events", _legit(), "flagged_events", "distinct_ips",
                    "distinct_flagged_ips"))


def verdict_rows(verdicts: DataFrame) -> DataFrame:
    """(batch_id, clean_rows, flagged_rows), counted row by row in one pass."""
    return verdicts.groupBy("batch_id").agg(
        F.count_if(F.col("reason").isNull()).alias("clean_rows"), F.count("reason").alias("flagged_rows"))


def conservation(metrics: DataFrame, rows: DataFrame) -> DataFrame:
    """Per batch: the metrics' totals against ``rows`` (clean and flagged rows
    counted independently); ``balanced`` when total = clean + flagged and the
    metrics agree with the tables."""
    m = metrics.select("batch_id", "total_events", "legit_events", "flagged_events")
    out = (m.join(rows, "batch_id", "full_outer")
           .withColumn("clean_rows", F.coalesce("clean_rows", F.lit(0).cast("long")))
           .withColumn("flagged_rows", F.coalesce("flagged_rows", F.lit(0).cast("long"))))
    balanced = ((F.col("total_events") == F.col("clean_rows") + F.col("flagged_rows"))
                & (F.col("legit_events") == F.col("clean_rows"))
                & (F.col("flagged_events") == F.col("flagged_rows")))
    return out.withColumn("balanced", F.coalesce(balanced, F.lit(False))).select(
        "batch_id", "total_events", "legit_events", "flagged_events", "clean_rows",
        "flagged_rows", "balanced")
