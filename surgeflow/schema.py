"""Schemas and fixed column lists of messages and output tables."""

from pyspark.sql.types import (LongType, StringType, StructField, StructType,
                               TimestampType)

# The six message fields, as sent on the wire (event time still text).
MESSAGE_FIELDS = ["event_id", "user_id", "action", "product_id", "timestamp", "ip_address"]
MESSAGE_SCHEMA = StructType([StructField(f, StringType(), True) for f in MESSAGE_FIELDS])

# Parsed event: the message with event time as a timestamp.
EVENT_COLUMNS = ["event_id", "user_id", "action", "product_id", "ip_address", "event_ts"]
REQUIRED_COLUMNS = list(EVENT_COLUMNS)

CLEAN_COLUMNS = EVENT_COLUMNS + ["batch_id"]
FLAGGED_COLUMNS = CLEAN_COLUMNS + ["reason"]
AGG_KEY = ["window_start", "product_id", "action"]
METRIC_COLUMNS = ["batch_id", "batch_ts", "total_events", "legit_events", "flagged_events",
                  "distinct_ips", "distinct_flagged_ips", "processing_time_ms"]

_S, _T, _L = StringType(), TimestampType(), LongType()

EVENTS_CLEAN_SCHEMA = StructType(
    [StructField(c, _S) for c in EVENT_COLUMNS[:5]]
    + [StructField("event_ts", _T), StructField("batch_id", _L), StructField("ingested_at", _T)])

EVENTS_FLAGGED_SCHEMA = StructType(
    [StructField(c, _S) for c in EVENT_COLUMNS[:5]]
    + [StructField("event_ts", _T), StructField("batch_id", _L), StructField("reason", _S),
       StructField("ingested_at", _T)])

EVENTS_AGG_DELTA_SCHEMA = StructType([
    StructField("window_start", _T), StructField("product_id", _S), StructField("action", _S),
    StructField("event_count", _L), StructField("batch_id", _L)])

PIPELINE_METRICS_SCHEMA = StructType([
    StructField("batch_ts", _T), StructField("total_events", _L), StructField("legit_events", _L),
    StructField("flagged_events", _L), StructField("distinct_ips", _L),
    StructField("distinct_flagged_ips", _L), StructField("processing_time_ms", _L),
    StructField("created_at", _T), StructField("batch_id", _L)])

DEAD_LETTER_SCHEMA = StructType(
    [StructField(c, _S) for c in EVENT_COLUMNS[:5]]
    + [StructField("event_ts", _T), StructField("raw", _S), StructField("error", _S),
       StructField("batch_id", _L)])

TABLE_SCHEMAS = {
    "events_clean": EVENTS_CLEAN_SCHEMA,
    "events_flagged": EVENTS_FLAGGED_SCHEMA,
    "events_agg": EVENTS_AGG_DELTA_SCHEMA,
    "pipeline_metrics": PIPELINE_METRICS_SCHEMA,
    "dead_letter": DEAD_LETTER_SCHEMA,
}

# Distribution column of each table (the sharding key of the original store).
DISTRIBUTION_COLUMN = {
    "events_clean": "product_id",
    "events_flagged": "ip_address",
    "events_agg": "product_id",
}
