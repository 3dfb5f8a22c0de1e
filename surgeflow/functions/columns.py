"""Scalar column expressions (all JVM-side built-ins, codegen-friendly)."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def raw_span_us(min_ts, max_ts) -> Column:
    """max - min of event time in microseconds; NULL bounds give 0."""
    return F.coalesce(F.unix_micros(_c(max_ts)) - F.unix_micros(_c(min_ts)), F.lit(0).cast("long"))


def effective_span_us(min_ts, max_ts, cfg: DetectorConfig) -> Column:
    """Span floored at the trigger interval, in microseconds."""
    return F.greatest(raw_span_us(min_ts, max_ts), F.lit(cfg.floor_us).cast("long"))


def instant(t: dt.datetime) -> Column:
    """A point in time as a timestamp literal, whatever zone driver or session are in."""
    micros = (t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros).cast("long"))


def span_seconds(span_us) -> Column:
    """Microseconds to seconds with fraction, as a double."""
    return _c(span_us) / F.lit(1e6)


def reason_text(cfg: DetectorConfig, span_us) -> Column:
    """``ip_rate_exceeded_<rate>_events_per_sec_over_<span:.1f>s_span``.

    The span's one-decimal text is rounded half-up on the exact microsecond
    count, so every engine prints the same text (binary float formatting can
    differ at exact .x5 ties).
    """
    tenths = F.floor((_c(span_us) + F.lit(50_000)) / F.lit(100_000)).cast("long")
    return F.concat(
        F.lit(f"ip_rate_exceeded_{cfg.rate_text}_events_per_sec_over_"),
        F.floor(tenths / 10).cast("long").cast("string"), F.lit("."),
        F.pmod(tenths, F.lit(10)).cast("string"), F.lit("s_span"))


def safe_pct(num, den, digits: int = 2) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), digits) as a double."""
    return F.round(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0)),
                   digits)


def ntz(col) -> Column:
    """Zoned timestamp (UTC session) to a zone-less timestamp for output."""
    return _c(col).cast("timestamp_ntz")


def key_number(col) -> Column:
    """A number from the whole key: the first 32 bits of its MD5, which any engine can compute."""
    return F.conv(F.substring(F.md5(_c(col).cast("binary")), 1, 8), 16, 10).cast("long")


def jvm_token() -> int:
    """Identity of the running JVM gateway; part of every expression-cache key."""
    sc = SparkContext._active_spark_context
    return id(sc._jvm) if sc is not None else 0


def reusable(fn):
    """Cache a builder of Column expressions per (arguments, JVM).

    Columns are immutable, unresolved expression trees, so one tree serves
    every micro-batch and query; building them costs driver round trips, not
    executor work.
    """
    cached = lru_cache(maxsize=64)(lambda token, *args: fn(*args))

    def wrapper(*args):
        return cached(jvm_token(), *args)
    wrapper.__doc__ = fn.__doc__
    wrapper.__name__ = fn.__name__
    return wrapper
