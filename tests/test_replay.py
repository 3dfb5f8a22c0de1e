"""Sink protocol: empty batches, replays and a failure between writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgeflow.config import FixedClock
from surgeflow.sources.sinks import append_jdbc, write_partition
from surgeflow.sources.tables import TABLES, read_raw_table, read_table
from surgeflow.streaming.micro_batch import BatchProcessor
from tests.helpers import CLOCK, DEFAULT, batch, msg, spread


def snapshot(spark, root, committed_only=True):
    out = {}
    for t in TABLES + ["dead_letter"]:
        df = read_table(spark, root, t, committed_only)
        cols = [c for c in df.columns if c not in ("ingested_at", "created_at")]
        out[t] = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    return out


def t2_batch(spark):
    return batch(spark, spread(26, "9.9.9.9", 4.0) + spread(5, "1.1.1.1", 4.0, start=100)
                 + [msg(500, None)])


def test_t6_empty_batch_writes_nothing(spark, sink_root):
    BatchProcessor(DEFAULT, sink_root, CLOCK)(batch(spark, []), 0)
    assert all(len(v) == 0 for v in snapshot(spark, sink_root).values())


def test_batch_outputs(spark, sink_root):
    BatchProcessor(DEFAULT, sink_root, CLOCK)(t2_batch(spark), 7)
    s = snapshot(spark, sink_root)
    assert len(s["events_clean"]) == 5 and len(s["events_flagged"]) == 26
    assert len(s["dead_letter"]) == 1
    (m,) = read_table(spark, sink_root, "pipeline_metrics").collect()
    assert (m["batch_id"], m["total_events"], m["legit_events"], m["flagged_events"],
            m["distinct_ips"], m["distinct_flagged_ips"]) == (7, 31, 5, 26, 2, 1)
    assert m["batch_ts"] == dt.datetime(2026, 6, 18, 12, 0, 0)
    agg = read_table(spark, sink_root, "events_agg").collect()
    assert sum(r["event_count"] for r in agg) == 5


def test_t8_replay_leaves_tables_unchanged(spark, sink_root):
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    proc(t2_batch(spark), 3)
    first = snapshot(spark, sink_root)
    proc(t2_batch(spark), 3)
    assert snapshot(spark, sink_root) == first


def test_t9_replay_with_no_rows_clears(spark, sink_root):
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    proc(t2_batch(spark), 4)
    proc(batch(spark, spread(3, "2.2.2.2", 1.0)), 5)
    proc(batch(spark, []), 4)
    s = snapshot(spark, sink_root, committed_only=False)
    assert len(s["events_flagged"]) == 0
    assert len(s["events_clean"]) == 3
    assert [r[0] for r in read_table(spark, sink_root, "pipeline_metrics").select("batch_id").collect()] == [5]


@pytest.mark.parametrize("fail_after", ["events_clean", "events_flagged", "events_agg"])
def test_failure_between_writes_then_rerun(spark, tmp_path, fail_after):
    clean_root, root = str(tmp_path / "ok"), str(tmp_path / "faulty")
    BatchProcessor(DEFAULT, clean_root, CLOCK)(t2_batch(spark), 1)
    with pytest.raises(RuntimeError):
        BatchProcessor(DEFAULT, root, CLOCK, fail_after=fail_after)(t2_batch(spark), 1)
    # nothing of the cut-off batch is visible: no commit mark yet
    assert all(len(v) == 0 for k, v in snapshot(spark, root).items() if k != "dead_letter")
    BatchProcessor(DEFAULT, root, CLOCK)(t2_batch(spark), 1)
    assert snapshot(spark, root) == snapshot(spark, clean_root)


def test_uncommitted_batch_hidden_until_metrics(spark, sink_root):
    ev = batch(spark, spread(3, "2.2.2.2", 1.0), keep_raw=False).withColumn(
        "batch_id", F.lit(9).cast("long"))
    write_partition(ev, sink_root, "events_clean", 9)
    assert read_raw_table(spark, sink_root, "events_clean").count() == 3
    assert read_table(spark, sink_root, "events_clean").count() == 0


def test_missing_tables_read_empty(spark, sink_root):
    for t in TABLES:
        assert read_table(spark, sink_root, t).count() == 0


def test_append_jdbc_skips_empty(spark):
    # No database is started in tests; an empty frame must not even connect.
    empty = spark.createDataFrame([], "a int")
    assert append_jdbc(empty, "jdbc:invalid://nowhere", "t", {}) is False


def test_replay_with_fewer_rows_leaves_no_stale_rows(spark, sink_root):
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    proc(t2_batch(spark), 6)
    proc(batch(spark, spread(4, "1.1.1.1", 4.0, start=100)), 6)
    s = snapshot(spark, sink_root)
    assert len(s["events_clean"]) == 4 and len(s["events_flagged"]) == 0
    assert len(s["dead_letter"]) == 0
    (m,) = read_table(spark, sink_root, "pipeline_metrics").collect()
    assert (m["total_events"], m["flagged_events"]) == (4, 0)


def test_batch_of_only_bad_messages(spark, sink_root):
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    proc(t2_batch(spark), 8)                     # an earlier run of the same id
    bad = batch(spark, ["not json", '{"event_id": "x"}', msg(1, None)])
    proc(bad, 8)
    s = snapshot(spark, sink_root, committed_only=False)
    assert len(s["dead_letter"]) == 3
    assert all(len(s[t]) == 0 for t in TABLES)  # cleared, and no commit mark


def test_event_time_minute_aggregate_is_replay_stable(spark, sink_root):
    import datetime as dt
    texts = spread(5, "1.1.1.1", 100.0, start=100)        # 10:00:00 .. 10:01:40
    BatchProcessor(DEFAULT, sink_root, CLOCK, agg_window="minute")(batch(spark, texts), 2)
    first = sorted(tuple(r) for r in read_table(spark, sink_root, "events_agg")
                   .select("window_start", "product_id", "event_count").collect())
    assert {r[0] for r in first} == {dt.datetime(2026, 6, 18, 10, 0), dt.datetime(2026, 6, 18, 10, 1)}
    other_clock = FixedClock(dt.datetime(2030, 1, 1))
    BatchProcessor(DEFAULT, sink_root, other_clock, agg_window="minute")(batch(spark, texts), 2)
    again = sorted(tuple(r) for r in read_table(spark, sink_root, "events_agg")
                   .select("window_start", "product_id", "event_count").collect())
    assert again == first


def backfill(spark, root, work, rate):
    from surgeflow import fixture
    from surgeflow.config import DetectorConfig
    from surgeflow.plans.history import derive_tables, write_history
    from tests.conftest import SF
    raw = fixture.load(spark, SF["0.001"])
    cfg = DetectorConfig(rate_per_sec=rate, floor_sec=5.0)
    write_history(derive_tables(fixture.clickstream(raw), cfg, fixture.surrogate_stamps(raw), fixture.window_stamp()), root, work)


def test_backfill_twice_equals_a_clean_one(spark, tmp_path):
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    for i, rate in enumerate((5.5 / 86400, 1e9, 0.0)):      # some flagged, then none, then every row
        backfill(spark, twice, str(tmp_path / f"w{i}"), rate)
        backfill(spark, f"{once}-{i}", str(tmp_path / f"v{i}"), rate)
        assert snapshot(spark, twice, committed_only=False) == snapshot(spark, f"{once}-{i}", committed_only=False)
    s = snapshot(spark, twice)
    assert len(s["events_flagged"]) == 1000 and len(s["events_clean"]) == 0 and len(s["events_agg"]) == 0


def test_stamps_are_utc_wherever_the_driver_is(spark, sink_root, monkeypatch):
    import time
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        BatchProcessor(DEFAULT, sink_root)(t2_batch(spark), 1)
        f = read_table(spark, sink_root, "pipeline_metrics").select(
            (F.unix_seconds(F.current_timestamp()) - F.unix_seconds("batch_ts")).alias("age")).first()
        a = read_table(spark, sink_root, "events_agg").select(
            (F.unix_seconds(F.current_timestamp()) - F.unix_seconds("window_start")).alias("age")).first()
        assert 0 <= f["age"] < 600 and 0 <= a["age"] < 600
    finally:
        monkeypatch.undo()
        time.tzset()
