"""JSON click messages: encode (key = product_id), decode, validate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.functions.columns import reusable
from surgeflow.schema import EVENT_COLUMNS, MESSAGE_SCHEMA, REQUIRED_COLUMNS

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def encode_messages(events: DataFrame, passthrough: list[str] = ()) -> DataFrame:
    """Events -> Kafka rows: ``key`` = product_id bytes, ``value`` = JSON bytes.

    Event time is written as ISO-8601 with microseconds and a ``+00:00``
    offset. The message key sets the Kafka partition, so one product's events
    stay ordered within a partition. ``passthrough`` columns are kept beside
    key and value (e.g. a batch id to lay files out by).
    """
    payload = F.to_json(F.struct(
        F.col("event_id"), F.col("user_id"), F.col("action"), F.col("product_id"),
        F.date_format(F.col("event_ts"), ISO_MICROS).alias("timestamp"),
        F.col("ip_address")))
    return events.select(F.col("product_id").cast("binary").alias("key"),
                         payload.cast("binary").alias("value"), *passthrough)


def parse_events(raw: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Message rows (``value`` binary or string) -> six fields with ``event_ts``.

    Malformed JSON becomes a row of NULLs, missing fields are NULL and extra
    fields are dropped; unparseable event time becomes NULL rather than
    failing the batch (``try_to_timestamp``). Text without an offset is read
    in the session zone (UTC).
    """
    text = F.col("value").cast("string")
    cols = [F.col(f"m.{c}") for c in MESSAGE_SCHEMA.fieldNames() if c != "timestamp"]
    out = [*cols, F.try_to_timestamp(F.col("m.timestamp")).alias("event_ts")]
    if keep_raw:
        out.append(F.col("raw"))
    return (raw.select(F.from_json(text, MESSAGE_SCHEMA).alias("m"), text.alias("raw"))
            .select(*out)
            .select(*EVENT_COLUMNS, *(["raw"] if keep_raw else [])))


def validation_error(required=REQUIRED_COLUMNS):
    """Comma list of NULL required fields, or NULL when the row is valid."""
    return _validation_error(tuple(required))


@reusable
def _validation_error(required: tuple) -> Column:
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return F.nullif(names, F.lit(""))


def with_validation(events: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    return events.withColumn("error", validation_error(required))


def validate_events(events: DataFrame, required=REQUIRED_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(valid, dead_letter): the NOT NULL check of the sink, as a split.

    A row with any NULL required field goes to the dead letter with the names
    of the missing fields in ``error``, instead of failing the whole batch.
    """
    checked = with_validation(events, required)
    valid = checked.filter("error IS NULL").drop("error")
    dead = checked.filter("error IS NOT NULL")
    return valid, dead
