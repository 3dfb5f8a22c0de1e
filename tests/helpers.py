"""Builders of handmade message batches for semantics tests."""

import datetime as dt
import json

from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig, FixedClock
from surgeflow.sources.messages import parse_events

T0 = dt.datetime(2026, 6, 18, 10, 0, 0)
DEFAULT = DetectorConfig(rate_per_sec=5.0, floor_sec=5.0)
CLOCK = FixedClock(dt.datetime(2026, 6, 18, 12, 0, 0))


def msg(i, ip, seconds=0.0, **over):
    ts = (T0 + dt.timedelta(seconds=seconds)).isoformat(timespec="microseconds") + "+00:00"
    m = {"event_id": f"e{i:05d}", "user_id": f"user_{i % 50:06d}", "action": "VIEW",
         "product_id": f"PRD-{i % 7 + 1:04d}", "timestamp": ts, "ip_address": ip}
    m.update(over)
    return json.dumps({k: v for k, v in m.items() if v is not ...})


def messages_df(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def batch(spark, texts, keep_raw=True):
    return parse_events(messages_df(spark, texts), keep_raw=keep_raw)


def spread(n, ip, span_sec, start=0):
    """n messages of one IP spread evenly over [0, span_sec]."""
    step = span_sec / (n - 1) if n > 1 else 0.0
    return [msg(start + i, ip, i * step) for i in range(n)]


def with_batch(df, bid=0):
    return df.withColumn("batch_id", F.lit(bid).cast("long"))
