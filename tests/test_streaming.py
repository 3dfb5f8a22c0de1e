"""Structured Streaming: a JSON-lines file stream, one file per day, gives
the same tables as the batch run over the whole history."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from surgeflow import fixture
from surgeflow.config import FixedClock, StreamConfig
from surgeflow.plans.analytics import message_rate
from surgeflow.plans.history import derive_tables
from surgeflow.sources.messages import ISO_MICROS
from surgeflow.sources.stream import SourceConfig, kafka_options, read_event_stream
from surgeflow.sources.tables import read_table
from surgeflow.streaming import BatchProcessor, start_message_rate, start_stream
from tests.conftest import SF


@pytest.fixture(scope="module")
def stream_dir(spark, tmp_path_factory):
    """sf0.001 clickstream as JSON lines, one file per batch, increasing mtimes."""
    d = tmp_path_factory.mktemp("stream")
    ev = fixture.clickstream_of(spark, SF["0.001"])
    data = (ev.select("batch_id", F.to_json(F.struct(
        "event_id", "user_id", "action", "product_id",
        F.date_format("event_ts", ISO_MICROS).alias("timestamp"),
        "ip_address")).alias("value")).collect())
    by_batch = {}
    for r in data:
        by_batch.setdefault(r["batch_id"], []).append(r["value"])
    base = 1_700_000_000
    for i, b in enumerate(sorted(by_batch)):
        p = d / f"day-{b:03d}.json"
        p.write_text("\n".join(by_batch[b]) + "\n")
        os.utime(p, (base + i * 10, base + i * 10))
    return str(d), sorted(by_batch)


def test_kafka_options():
    o = kafka_options(SourceConfig(bootstrap_servers="b:9092", topic="t", extra={"maxOffsetsPerTrigger": "1000"},
                                   min_partitions=48))
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "latest",
                 "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000", "minPartitions": "48"}


def test_stream_equals_batch(spark, stream_dir, tmp_path):
    path, batches = stream_dir
    assert batches == list(range(30))
    stream = read_event_stream(spark, SourceConfig(format="json-files", path=path,
                                                   max_files_per_trigger=1))
    clock = FixedClock(dt.datetime(2024, 2, 1))
    root = str(tmp_path / "tables")
    q = start_stream(stream, fixture.FIXTURE_CONFIG,
                     StreamConfig(sink_root=root, checkpoint_location=str(tmp_path / "ckpt"),
                                  available_now=True), clock)
    q.awaitTermination(600)
    assert q.exception() is None

    raw = fixture.load(spark, SF["0.001"])
    ref = derive_tables(fixture.clickstream(raw), fixture.FIXTURE_CONFIG,
                        fixture.surrogate_stamps(raw), fixture.window_stamp())

    def rows(df, cols):
        return sorted(tuple(r) for r in df.select(*cols).collect())

    cols = ["event_id", "user_id", "action", "product_id", "ip_address", "event_ts", "batch_id"]
    assert rows(read_table(spark, root, "events_clean"), cols) == rows(ref.clean, cols)
    assert rows(read_table(spark, root, "events_flagged"), cols + ["reason"]) == \
        rows(ref.flagged, cols + ["reason"])
    mcols = ["batch_id", "total_events", "legit_events", "flagged_events", "distinct_ips",
             "distinct_flagged_ips"]
    assert rows(read_table(spark, root, "pipeline_metrics"), mcols) == rows(ref.metrics, mcols)
    agg = read_table(spark, root, "events_agg")
    assert rows(agg, ["batch_id", "product_id", "action", "event_count"]) == \
        rows(ref.agg_deltas, ["batch_id", "product_id", "action", "event_count"])


def test_stream_restart_resumes_from_checkpoint(spark, stream_dir, tmp_path):
    path, _ = stream_dir
    conf = SourceConfig(format="json-files", path=path, max_files_per_trigger=10)
    scfg = StreamConfig(sink_root=str(tmp_path / "t"), checkpoint_location=str(tmp_path / "c"),
                        available_now=True)
    clock = FixedClock(dt.datetime(2024, 2, 1))
    for _ in range(2):  # second run finds every file already committed
        q = start_stream(read_event_stream(spark, conf), fixture.FIXTURE_CONFIG, scfg, clock)
        q.awaitTermination(600)
        assert q.exception() is None
    m = read_table(spark, scfg.sink_root, "pipeline_metrics")
    assert m.count() == 3  # 30 files, 10 per trigger, three batches
    assert m.agg(F.sum("total_events")).first()[0] == 1000


def test_streaming_message_rate(spark, stream_dir, tmp_path):
    path, _ = stream_dir
    stream = read_event_stream(spark, SourceConfig(format="json-files", path=path,
                                                   max_files_per_trigger=5), watermark="1 minute")
    out = str(tmp_path / "rate")
    q = start_message_rate(stream, out, str(tmp_path / "rc"), 60, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    got = {r["window_start"]: r["messages"] for r in spark.read.parquet(out).collect()}
    want = {r["window_start"]: r["messages"]
            for r in message_rate(fixture.clickstream_of(spark, SF["0.001"])).collect()}
    seen = max(r["window_end"] for r in message_rate(fixture.clickstream_of(spark, SF["0.001"])).collect())
    closed = {k: v for k, v in want.items() if k + dt.timedelta(minutes=3) <= seen}
    assert closed and all(got.get(k) == v for k, v in closed.items())  # every window the watermark has passed
    assert all(want[k] == v for k, v in got.items())


def test_cli_runs_file_stream_into_shared_folder(spark, stream_dir, tmp_path):
    import shutil

    from surgeflow.streaming.job import main, stream_config
    src, _ = stream_dir
    small = tmp_path / "in"
    small.mkdir()
    for name in sorted(os.listdir(src))[:3]:
        shutil.copy(os.path.join(src, name), small / name)
    name = f"cli-{os.getpid()}"
    main(["--json-path", str(small), "--available-now", "--name", name, "--files-per-trigger", "1",
          "--rate", str(fixture.FIXTURE_CONFIG.rate_per_sec)])
    scfg = stream_config(spark, name)
    base = spark.conf.get("spark.checkpoint.dir")
    assert scfg.sink_root.startswith(base) and scfg.checkpoint_location.startswith(base)
    m = read_table(spark, scfg.sink_root, "pipeline_metrics")
    assert m.count() == 3
    main(["--name", name, "--compact-upto", "1"])             # maintenance run
    m = read_table(spark, scfg.sink_root, "pipeline_metrics")
    assert sorted(r[0] for r in m.select("batch_id").collect()) == [0, 1, 2]
    assert sorted(os.listdir(os.path.join(scfg.sink_root, "events_clean"))) == ["batch_id=2"]


class FailOnce(BatchProcessor):
    """Fails once, after the flagged write of one batch: a crash mid-batch."""

    def __init__(self, *a, fail_batch: int, **kw):
        super().__init__(*a, **kw)
        self.fail_batch = fail_batch
        self.failed = False

    def __call__(self, batch_df, batch_id):
        self.fail_after = None
        if batch_id == self.fail_batch and not self.failed:
            self.failed = True
            self.fail_after = "events_flagged"
        return super().__call__(batch_df, batch_id)


def test_crash_mid_batch_then_restart_equals_clean_run(spark, stream_dir, tmp_path):
    path, _ = stream_dir
    conf = SourceConfig(format="json-files", path=path, max_files_per_trigger=10)
    clock = FixedClock(dt.datetime(2024, 2, 1))

    def run(root, ckpt, proc):
        scfg = StreamConfig(sink_root=root, checkpoint_location=ckpt, available_now=True)
        q = start_stream(read_event_stream(spark, conf), fixture.FIXTURE_CONFIG, scfg, clock,
                         processor=proc)
        try:
            q.awaitTermination(600)
        except Exception:
            pass
        return q

    ok_root = str(tmp_path / "ok")
    run(ok_root, str(tmp_path / "ok_ckpt"), BatchProcessor(fixture.FIXTURE_CONFIG, ok_root, clock))

    root, ckpt = str(tmp_path / "t"), str(tmp_path / "c")
    crashing = FailOnce(fixture.FIXTURE_CONFIG, root, clock, fail_batch=1)
    q = run(root, ckpt, crashing)
    assert crashing.failed and q.exception() is not None
    assert read_table(spark, root, "pipeline_metrics").count() == 1   # batch 1 not committed
    q = run(root, ckpt, crashing)                                      # restart: batch 1 replayed
    assert q.exception() is None

    def rows(r, t, cols):
        return sorted(tuple(x) for x in read_table(spark, r, t).select(*cols).collect())
    ev_cols = ["event_id", "ip_address", "event_ts", "batch_id"]
    for t, cols in (("events_clean", ev_cols), ("events_flagged", ev_cols + ["reason"]),
                    ("events_agg", ["batch_id", "window_start", "product_id", "action", "event_count"]),
                    ("pipeline_metrics", ["batch_id", "total_events", "legit_events",
                                          "flagged_events", "distinct_ips", "distinct_flagged_ips"])):
        assert rows(root, t, cols) == rows(ok_root, t, cols), t
