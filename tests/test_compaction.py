"""Compacting closed batch ranges keeps every reader's answer unchanged and
replaces many per-batch directories by one range."""

import os

from pyspark.sql import functions as F

from surgeflow.operators.aggregate import upsert_view
from surgeflow.sources.tables import (TABLES, closed_upto, compact, compact_closed, compacted_ranges, read_raw_table,
                                      read_table)
from surgeflow.streaming.micro_batch import BatchProcessor
from tests.helpers import CLOCK, DEFAULT, batch, msg, spread


def day(spark, k):
    return batch(spark, spread(26 + k, f"9.9.9.{k}", 4.0, start=1000 * k)
                 + spread(5, "1.1.1.1", 4.0, start=1000 * k + 500) + [msg(1000 * k + 900, None)])


def state(spark, root):
    out = {}
    for t in TABLES:
        df = read_table(spark, root, t)
        if t == "events_agg":
            df = upsert_view(df)
        cols = [c for c in df.columns if c not in ("ingested_at", "created_at")]
        out[t] = sorted(tuple(r) for r in df.select(*cols).collect())
    out["dead_letter"] = read_raw_table(spark, root, "dead_letter").count()
    return out


def test_compaction_preserves_tables(spark, sink_root):
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    for k in range(5):
        proc(day(spark, k), k)
    before = state(spark, sink_root)
    assert compact_closed(spark, sink_root, 2) == {t: True for t in
                                                   ["dead_letter"] + TABLES}
    assert state(spark, sink_root) == before
    live = sorted(os.listdir(os.path.join(sink_root, "events_clean")))
    assert [d for d in live if d.startswith("batch_id=")] == ["batch_id=3", "batch_id=4"]
    assert compacted_ranges(spark, sink_root, "events_clean") == [2]

    proc(day(spark, 5), 5)                       # the stream goes on
    proc(day(spark, 4), 4)                       # an open batch is replayed
    after_more = state(spark, sink_root)
    compact_closed(spark, sink_root, 4)
    assert state(spark, sink_root) == after_more
    assert compacted_ranges(spark, sink_root, "pipeline_metrics") == [2, 4]
    assert compact_closed(spark, sink_root, 3)["events_clean"] is False   # already closed
    assert closed_upto(spark, sink_root) == 4
    m = read_table(spark, sink_root, "pipeline_metrics")
    assert sorted(r[0] for r in m.select("batch_id").collect()) == [0, 1, 2, 3, 4, 5]
    assert m.agg(F.sum("flagged_events")).first()[0] == sum(26 + k for k in range(6))


def test_replay_into_compacted_range_is_refused(spark, sink_root):
    import pytest
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    for k in range(3):
        proc(day(spark, k), k)
    compact_closed(spark, sink_root, 1)
    before = state(spark, sink_root)
    with pytest.raises(ValueError):
        proc(day(spark, 1), 1)
    proc(day(spark, 2), 2)                      # the open batch still replays
    assert state(spark, sink_root) == before


def test_cut_off_batch_is_never_closed(spark, sink_root):
    import pytest
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    for k in range(3):
        proc(day(spark, k), k)
    with pytest.raises(RuntimeError):
        BatchProcessor(DEFAULT, sink_root, CLOCK, fail_after="events_clean", parallel_writes=False)(day(spark, 3), 3)
    for upto in (3, 10):                        # above the last committed batch
        with pytest.raises(ValueError):
            compact_closed(spark, sink_root, upto)
    proc(day(spark, 3), 3)                      # its replay is still possible
    with pytest.raises(RuntimeError):
        BatchProcessor(DEFAULT, sink_root, CLOCK, fail_after="events_clean", parallel_writes=False)(day(spark, 2), 2)
    with pytest.raises(ValueError):             # a hole below the last committed batch
        compact_closed(spark, sink_root, 3)
    proc(day(spark, 2), 2)
    before = state(spark, sink_root)
    compact_closed(spark, sink_root, 3)
    assert state(spark, sink_root) == before


def test_compaction_cut_off_half_way(spark, sink_root, monkeypatch):
    import pytest

    from surgeflow.sources import tables
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    for k in range(4):
        proc(day(spark, k), k)
    before = state(spark, sink_root)

    def fails(spark, root, table, upto):
        if table == "events_flagged":
            raise OSError("cut off")
        return compact(spark, root, table, upto)

    monkeypatch.setattr(tables, "compact", fails)
    with pytest.raises(OSError):
        compact_closed(spark, sink_root, 2)
    monkeypatch.setattr(tables, "compact", compact)
    assert state(spark, sink_root) == before
    with pytest.raises(ValueError):             # the range is closed already, for every table
        proc(day(spark, 1), 1)
    compact_closed(spark, sink_root, 2)         # finishes what was begun
    assert state(spark, sink_root) == before
    assert compacted_ranges(spark, sink_root, "pipeline_metrics") == [2]


def test_backfill_into_closed_range_is_refused(spark, sink_root, tmp_path):
    import pytest

    from tests.test_replay import backfill
    backfill(spark, sink_root, str(tmp_path / "w"), 5.5 / 86400)
    compact_closed(spark, sink_root, 3)
    with pytest.raises(ValueError):
        backfill(spark, sink_root, str(tmp_path / "w2"), 5.5 / 86400)


def test_compaction_removes_what_a_cut_off_run_wrote(spark, sink_root):
    from pathlib import Path
    proc = BatchProcessor(DEFAULT, sink_root, CLOCK)
    for k in range(2):
        proc(day(spark, k), k)
    before = state(spark, sink_root)
    left = Path(sink_root) / "events_clean_compacted" / "_tmp-0"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_text("half a file")
    assert state(spark, sink_root) == before    # never read
    compact_closed(spark, sink_root, 0)
    assert not left.exists() and state(spark, sink_root) == before
