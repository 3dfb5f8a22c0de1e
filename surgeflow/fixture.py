"""Driver test tables -> clickstream events (FIXTURES mapping).

``events(event_id bigint, ts timestamp_ntz, user_id bigint, event_type,
value, props)`` becomes the six clickstream fields plus a day ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig
from surgeflow.functions.columns import reusable

# Fixed values for runs on the driver's tables: the day is the batch, and the
# rule uses 5.5 events per day with a 5 s floor (the 5 events/s default flags
# nothing on these sparse days).
EPOCH_DAY = "2024-01-01"
FIXTURE_CONFIG = DetectorConfig(rate_per_sec=5.5 / 86400, floor_sec=5.0)
N_SHARDS = 32
N_NODES = 3
BOT_USER_MODULUS = 15
PROCESSING_MS_MODULUS = 97
BATCHES_PER_MINUTE = 3
# Runs of the per-batch function: several days a batch, and a rate at which some are flagged.
PIPELINE_DAYS = 5
PIPELINE_CONFIG = DetectorConfig(rate_per_sec=3.6 / 86400, floor_sec=5.0)
# Fields that some messages lack, by the event number's remainder of 100.
MISSING_FIELDS = {7: "ip_address", 13: "event_ts", 29: "product_id", 57: "user_id"}
PHASE_OFFSET_MS = 250
DEAD_LETTER_DAYS = 15
WRITTEN_CONFIG = DetectorConfig(rate_per_sec=2.4 / 86400, floor_sec=5.0)
# Windows of the event-time rule: six hours, at a rate that flags some.
WINDOW_SECONDS = 6 * 3600
WINDOW_CONFIG = DetectorConfig(rate_per_sec=10 / 86400, floor_sec=5.0)
# Arrival in micro-batches: events of these numbers (modulo 40) come so many batches late.
ARRIVAL_DELAYS = {3: 1, 7: 2}
LATE_DELAY_SECONDS = 90
# Rows of these numbers are altered where a planted change is wanted.
ALTERED_MODULUS, ALTERED = 911, 17
TRAILING_SECONDS, SAMPLE_SECONDS = 600, 60


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def load(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The driver's events table, read with its declared schema (no schema
    inference job)."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clickstream(raw: DataFrame) -> DataFrame:
    """Six message fields with a parsed ``event_ts`` and the day ``batch_id``."""
    return raw.select(*_clickstream_columns())


@reusable
def _clickstream_columns():
    k = F.from_json(F.col("props"), "k bigint").getField("k")
    return (
        F.format_string("%032x", F.col("event_id")).alias("event_id"),
        F.format_string("user_%06d", F.col("user_id")).alias("user_id"),
        F.col("event_type").alias("action"),
        F.format_string("PRD-%04d", k).alias("product_id"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("ip_address"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.datediff(F.col("ts"), F.lit(EPOCH_DAY)).cast("long").alias("batch_id"),
    )


def clickstream_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream(load(spark, sf_dir, "events"))


def batch_stamp():
    """Surrogate stamp of the ``batch_id`` column: three batches share a minute, 20 s apart."""
    b = F.col("batch_id")
    micros = (F.floor(b / BATCHES_PER_MINUTE) * 60 + F.pmod(b, F.lit(BATCHES_PER_MINUTE)) * 20) * 1_000_000
    return F.timestamp_micros(F.unix_micros(F.lit(EPOCH_DAY).cast("timestamp")) + micros)


@reusable
def window_stamp():
    """The minute of ``batch_stamp``, as the key of aggregates that several batches add to."""
    return F.date_trunc("minute", batch_stamp())


def surrogate_stamps(raw: DataFrame) -> DataFrame:
    """(batch_id, batch_ts, processing_time_ms) standing in for wall-clock
    fields, from the raw events table.

    processing_time_ms = sum(source event id mod 97) per batch, a deterministic
    stand-in for the elapsed time of a real micro-batch.
    """
    key, ms, stamp = _stamp_columns()
    return raw.groupBy(key).agg(ms).select("batch_id", stamp, "processing_time_ms")


@reusable
def _stamp_columns():
    return (F.datediff(F.col("ts"), F.lit(EPOCH_DAY)).cast("long").alias("batch_id"),
            F.sum(F.pmod(F.col("event_id"), F.lit(PROCESSING_MS_MODULUS))).cast("long")
            .alias("processing_time_ms"),
            batch_stamp().alias("batch_ts"))


def is_bot_label(user_id="user_id"):
    """Known-bot label of the fixture: numeric user id divisible by 15."""
    u = F.col(user_id) if isinstance(user_id, str) else user_id
    return F.pmod(F.regexp_extract(u, r"(\d+)$", 1).cast("long"), F.lit(BOT_USER_MODULUS)) == 0


def some_invalid(events: DataFrame) -> DataFrame:
    """Events of which those with certain numbers lack a required field."""
    number = F.pmod(F.conv(F.col("event_id"), 16, 10).cast("long"), F.lit(100))
    lacks = {c: k for k, c in MISSING_FIELDS.items()}
    return events.select(*[F.when(number != lacks[c], F.col(c)).alias(c) if c in lacks else F.col(c)
                           for c in events.columns])


def day_phases(events: DataFrame) -> DataFrame:
    """A phase of one day for every day that the events span, each beginning
    ``PHASE_OFFSET_MS`` after midnight, with a uniform target (eps NULL)."""
    span = events.agg(F.min(F.to_date("event_ts")).alias("lo"), F.max(F.to_date("event_ts")).alias("hi"))
    days = span.select(F.explode(F.expr("sequence(lo, hi)")).alias("day"))

    def start(day):
        return F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + F.lit(PHASE_OFFSET_MS * 1000))

    return days.select(F.datediff("day", F.lit(EPOCH_DAY)).cast("long").alias("phase_id"), start(F.col("day")).alias("start_ts"),
                       start(F.date_add("day", 1)).alias("end_ts"), F.lit(None).cast("double").alias("eps"))


def event_number() -> Column:
    return F.conv(F.col("event_id"), 16, 10).cast("long")


def arrivals(events: DataFrame) -> DataFrame:
    """Events with ``run``, the micro-batch that they arrive in: days of their event
    time, but for those that come late."""
    late = F.lit(0)
    for remainder, batches in ARRIVAL_DELAYS.items():
        late = F.when(F.pmod(event_number(), F.lit(40)) == remainder, F.lit(batches)).otherwise(late)
    return events.withColumn("run", F.floor(F.col("batch_id") / PIPELINE_DAYS) + late)


def some_altered(events: DataFrame) -> DataFrame:
    """Events of which those with certain numbers have another action: as many rows, other content."""
    hit = F.pmod(event_number(), F.lit(ALTERED_MODULUS)) == ALTERED
    return events.withColumn("action", F.when(hit, F.lit("altered")).otherwise(F.col("action")))
