"""Event-time windows of the stream: verdicts, late rows, message counts.

``start_window_detector`` runs the rule over event-time windows as stateful
operators under the stream's watermark, into a file sink that appends each window
once, whatever is replayed.

``LateSplit`` is a ``foreachBatch`` function for what such a window leaves out. It
holds each batch against the query's watermark (the latest event time of all batches
before, less the delay): rows whose window that watermark has closed are kept in
``late_events`` with how far they are behind, all others go on to the function
inside, so that per batch on time + late = input. A batch's mark is written last and
holds the running maximum, so that the next batch reads one row of it, and a replayed
batch, which stands at the same mark, splits as it did before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surgeflow.config import DetectorConfig
from surgeflow.functions.columns import ntz
from surgeflow.plans.windows import shown, window_flagged, window_metrics, window_verdicts
from surgeflow.schema import EVENT_COLUMNS
from surgeflow.sources.tables import batch_path, path_exists, table_path

MARK_SCHEMA = "watermark_us long, max_event_us long, input_rows long, on_time_rows long, late_rows long"
LATE_SCHEMA = "event_id string, user_id string, action string, product_id string, ip_address string, event_ts timestamp, behind_us long"


def _trigger(writer, available_now: bool, trigger_seconds: int):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{trigger_seconds} seconds")


def start_window_detector(stream: DataFrame, cfg: DetectorConfig, path: str, checkpoint: str, window_seconds: int = 60,
                          output: str = "verdicts", available_now: bool = False, trigger_seconds: int = 5) -> StreamingQuery:
    """Append to ``path`` what each closed window gives: its ``verdicts`` per IP, its
    ``metrics`` or its ``flagged`` events. ``stream`` carries a watermark; rows
    without an event time are in no window."""
    verdicts = window_verdicts(stream, cfg, window_seconds)
    out = {"verdicts": lambda: shown(verdicts), "metrics": lambda: window_metrics(verdicts, window_seconds),
           "flagged": lambda: window_flagged(stream, verdicts, window_seconds)}[output]()
    writer = (out.writeStream.outputMode("append").format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, available_now, trigger_seconds).start()


class LateSplit:
    """``foreachBatch`` function: late rows aside, the others to ``inner(df, batch_id)``.

    A row is late when the watermark has passed the end of its window of
    ``window_seconds``. Rows without an event time are never late: the function
    inside sends them to its dead letter.
    """

    def __init__(self, inner: Callable[[DataFrame, int], None], root: str, delay_seconds: float = 60.0, window_seconds: int = 60):
        self.inner, self.root = inner, root
        self.delay_us, self.window_us = int(round(delay_seconds * 1_000_000)), int(window_seconds) * 1_000_000

    def _mark(self, spark: SparkSession, batch_id: int):
        """Latest event time of all batches before, or None; one row is read."""
        path = batch_path(self.root, "late_marks", batch_id - 1)
        if batch_id <= 0 or not path_exists(spark, path):
            return None
        return spark.read.schema(MARK_SCHEMA).parquet(path).first()["max_event_us"]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark, bid = batch_df.sparkSession, int(batch_id)
        before = self._mark(spark, bid)
        watermark = None if before is None else before - self.delay_us
        us = F.unix_micros("event_ts")
        closes = (F.floor(us / self.window_us) + 1) * self.window_us
        late = F.lit(False) if watermark is None else F.coalesce(closes <= F.lit(watermark), F.lit(False))
        rows = batch_df.withColumn("_late", late).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"), F.max(us).alias("us")).first()
            behind = F.lit(watermark).cast("long") - us
            (rows.where("_late").select(*EVENT_COLUMNS, behind.alias("behind_us"))
             .write.mode("overwrite").parquet(batch_path(self.root, "late_events", bid)))
            self.inner(rows.where("NOT _late").drop("_late"), bid)
            latest = max((x for x in (before, n["us"]) if x is not None), default=None)
            mark = spark.createDataFrame([(watermark, latest, n["rows"], n["rows"] - n["late"], n["late"])], MARK_SCHEMA)
            mark.coalesce(1).write.mode("overwrite").parquet(batch_path(self.root, "late_marks", bid))
        finally:
            rows.unpersist()


def _stored(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    path = table_path(root, table)
    schema = f"{schema}, batch_id long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def late_marks(spark: SparkSession, root: str) -> DataFrame:
    """Per batch: watermark, latest event time so far, input, on-time and late rows."""
    return _stored(spark, root, "late_marks", MARK_SCHEMA)


def late_events(spark: SparkSession, root: str) -> DataFrame:
    """The late rows of batches that were finished."""
    marks = late_marks(spark, root).select("batch_id")
    return _stored(spark, root, "late_events", LATE_SCHEMA).join(marks, "batch_id", "left_semi")


class WindowCounts:
    """``foreachBatch`` function: messages per event-time window of a batch, to be added up."""

    SCHEMA = "window_us long, messages long"

    def __init__(self, root: str, window_seconds: int = 60):
        self.root, self.window_us = root, int(window_seconds) * 1_000_000

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        start = F.floor(F.unix_micros("event_ts") / self.window_us) * self.window_us
        (batch_df.where("event_ts IS NOT NULL").groupBy(start.alias("window_us")).agg(F.count(F.lit(1)).alias("messages"))
         .write.mode("overwrite").parquet(batch_path(self.root, "window_counts", int(batch_id))))

    def closed(self, spark: SparkSession, delay_seconds: float) -> DataFrame:
        """Rate of the windows that the watermark has closed: window_start, window_end, messages, rate_per_sec."""
        marks = late_marks(spark, self.root)
        latest = marks.agg((F.max("max_event_us") - int(round(delay_seconds * 1_000_000))).alias("watermark"))
        counts = _stored(spark, self.root, "window_counts", self.SCHEMA).join(marks.select("batch_id"), "batch_id", "left_semi")
        sums = counts.groupBy("window_us").agg(F.sum("messages").cast("long").alias("messages"))
        end = F.col("window_us") + self.window_us
        return (sums.where(end <= latest.scalar())
                .select(ntz(F.timestamp_micros("window_us")).alias("window_start"), ntz(F.timestamp_micros(end)).alias("window_end"),
                        "messages", (F.col("messages") / F.lit(self.window_us / 1e6)).alias("rate_per_sec")))


def start_counted_rate(stream: DataFrame, root: str, checkpoint: str, window_seconds: int = 60, delay_seconds: float = 60.0,
                       available_now: bool = False, trigger_seconds: int = 5) -> StreamingQuery:
    """The message rate with its late rows kept: ``WindowCounts`` behind a ``LateSplit``."""
    split = LateSplit(WindowCounts(root, window_seconds), root, delay_seconds, window_seconds)
    writer = stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, trigger_seconds).start()
