"""Starting the streaming job: source -> foreachBatch split -> tables."""

from __future__ import annotations

import argparse
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


from surgeflow.config import DetectorConfig, StreamConfig
from surgeflow.session import build_session, shared_dir
from surgeflow.sources.stream import SourceConfig, read_event_stream
from surgeflow.sources.tables import compact_closed
from surgeflow.plans.analytics import message_rate
from surgeflow.streaming.micro_batch import BatchProcessor


def start_stream(stream: DataFrame, cfg: DetectorConfig, scfg: StreamConfig, clock=None,
                 processor: BatchProcessor | None = None) -> StreamingQuery:
    """Run the split per trigger with durable, checkpointed offsets.

    The checkpoint location must be on shared storage (e.g. under
    ``spark.checkpoint.dir``) so a restarted driver resumes where it stopped
    instead of jumping to the latest offsets.
    """
    proc = processor or BatchProcessor(cfg, scfg.sink_root, clock)
    writer = (stream.writeStream.foreachBatch(proc)
              .option("checkpointLocation", scfg.checkpoint_location)
              .queryName("split-" + hashlib.md5(scfg.sink_root.encode()).hexdigest()[:8]))
    if scfg.available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{scfg.trigger_seconds} seconds")
    return writer.start()


def start_message_rate(stream: DataFrame, path: str, checkpoint: str, window_seconds: int = 60,
                       available_now: bool = False) -> StreamingQuery:
    """Per-window message rate under the stream's watermark, appended to
    Parquet once each window is final (late rows past the watermark are
    dropped by the state store, not counted twice)."""
    writer = (message_rate(stream, window_seconds).writeStream.outputMode("append")
              .format("parquet").option("path", path).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def stream_config(spark: SparkSession, name: str, sink_root: str | None = None,
                  trigger_seconds: int = 5, available_now: bool = False, checkpoint: str | None = None,
                  watermark: str = "1 minute") -> StreamConfig:
    """Stream settings whose sink and checkpoint default to the cluster's
    shared folder (``spark.checkpoint.dir``), never a machine-local one."""
    return StreamConfig(sink_root=sink_root or shared_dir(spark, "tables", name),
                        checkpoint_location=checkpoint or shared_dir(spark, "streams", name),
                        trigger_seconds=trigger_seconds, available_now=available_now, watermark=watermark)


def main(argv=None) -> None:
    """Run the split job: Kafka (or a JSON-lines folder) -> four tables."""
    ap = argparse.ArgumentParser(prog="surgeflow-stream")
    ap.add_argument("--bootstrap-servers", default="")
    ap.add_argument("--topic", default="clickstream-events")
    ap.add_argument("--json-path", default="", help="read JSON-lines files instead of Kafka")
    ap.add_argument("--sink-root", default=None)
    ap.add_argument("--name", default="clickstream")
    ap.add_argument("--rate", type=float, default=5.0, help="events per second per IP")
    ap.add_argument("--trigger-seconds", type=int, default=5)
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--checkpoint", default=None, help="checkpoint location (default: in the shared folder)")
    ap.add_argument("--watermark", default="1 minute")
    ap.add_argument("--files-per-trigger", type=int, default=None,
                    help="JSON-lines files a batch takes at most (default: all that are new)")
    ap.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE",
                    help="any further option of the source, e.g. maxOffsetsPerTrigger")
    ap.add_argument("--min-partitions", type=int, default=None,
                    help="Spark partitions per batch at least (splits Kafka offset ranges)")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--compact-upto", type=int, default=None,
                    help="maintenance: compact the closed batches <= this id of the sink and exit")
    ap.add_argument("--agg-window", default=None,
                    help="key events_agg by an event-time bucket (e.g. minute) instead of the batch stamp")
    a = ap.parse_args(argv)
    spark = build_session(app_name="surgeflow-stream")
    extra = dict(o.split("=", 1) for o in a.source_option)
    src = (SourceConfig(format="json-files", path=a.json_path, max_files_per_trigger=a.files_per_trigger, extra=extra)
           if a.json_path else
           SourceConfig(bootstrap_servers=a.bootstrap_servers, topic=a.topic, starting_offsets=a.starting_offsets,
                        min_partitions=a.min_partitions, extra=extra))
    cfg = DetectorConfig(rate_per_sec=a.rate, floor_sec=float(a.trigger_seconds))
    scfg = stream_config(spark, a.name, a.sink_root, a.trigger_seconds, a.available_now, a.checkpoint, a.watermark)
    if a.compact_upto is not None:
        print(compact_closed(spark, scfg.sink_root, a.compact_upto))
        return
    q = start_stream(read_event_stream(spark, src, scfg.watermark), cfg, scfg,
                     processor=BatchProcessor(cfg, scfg.sink_root, log=print,
                                              agg_window=a.agg_window))
    q.awaitTermination()


if __name__ == "__main__":
    main()
