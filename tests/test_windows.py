"""Event-time windows: the streaming detector, late rows, the trailing rate, triggers."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surgeflow import fixture
from surgeflow.config import DetectorConfig, FixedClock, StreamConfig
from surgeflow.plans.windows import shown, trailing_rate, window_flagged, window_metrics, window_verdicts
from surgeflow.schema import EVENT_COLUMNS
from surgeflow.sources.messages import parse_events
from surgeflow.sources.stream import SourceConfig, read_event_stream
from surgeflow.sources.tables import read_table
from surgeflow.streaming import start_stream
from surgeflow.streaming.windows import LateSplit, WindowCounts, late_events, late_marks, start_counted_rate, start_window_detector
from tests.conftest import SF
from tests.helpers import T0, batch, messages_df, msg

CFG = DetectorConfig(rate_per_sec=0.05, floor_sec=5.0)  # more than 3 a minute


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def traffic(seed=1, n=300, minutes=20):
    """Messages of some IPs over some minutes, in time order, with what lacks a time."""
    rng = random.Random(seed)
    at = sorted(rng.uniform(0, minutes * 60) for _ in range(n))
    out = [msg(i, f"10.0.0.{rng.choice([1, 1, 1, 2, 3, 4, 5, 6])}", t) for i, t in enumerate(at)]
    return out + [msg(n, "10.0.0.1", 3.0, timestamp="soon"), msg(n + 1, "10.0.0.9", 4.0, timestamp=None)]


def put_files(path, parts):
    os.makedirs(path, exist_ok=True)
    done = len(os.listdir(path))
    for i, part in enumerate(parts):
        p = os.path.join(path, f"f{done + i:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(part) + "\n")
        os.utime(p, (1_700_000_000 + 10 * (done + i),) * 2)


def cut(lines, n):
    size = -(-len(lines) // n)
    return [lines[i:i + size] for i in range(0, len(lines), size)]


def watermark_of(df):
    return df.agg(F.max("event_ts")).first()[0].replace(tzinfo=None) - dt.timedelta(minutes=1)


BATCH = {"verdicts": lambda ev: shown(window_verdicts(ev, CFG)),
         "metrics": lambda ev: window_metrics(window_verdicts(ev, CFG)),
         "flagged": lambda ev: window_flagged(ev, window_verdicts(ev, CFG))}


@pytest.mark.parametrize("output", sorted(BATCH))
def test_detector_stream_equals_batch(spark, tmp_path, output):
    """Each closed window comes out once, as the batch plan has it; a second run from the
    checkpoint, in which more files have come, goes on where the first stopped."""
    lines = traffic()
    files = cut(lines, 6)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (files[:3], files[3:]):
        put_files(src, part)
        stream = read_event_stream(spark, SourceConfig(format="json-files", path=src, max_files_per_trigger=1))
        q = start_window_detector(stream, CFG, out, str(tmp_path / "ck"), output=output, available_now=True)
        q.awaitTermination(600)
        assert q.exception() is None
    events = batch(spark, lines, keep_raw=False)
    wm = watermark_of(events)
    want = BATCH[output](events).where(F.col("window_end") <= F.lit(wm))
    got = rows(spark.read.parquet(out))
    if output == "verdicts":  # behind the last batch a further one closes what its watermark has passed
        assert got == rows(want) and any(r[5] for r in got) and not all(r[5] for r in got)
    else:  # a second stateful operator closes a window one watermark later
        assert got and set(got) <= set(rows(want)) and len(got) == len(set(got))
        closed = {r[0] for r in got}
        assert got == [r for r in rows(want) if r[0] in closed]
        starts = sorted({r[0] for r in rows(want)})
        assert sorted(closed) == starts[:len(closed)] and len(closed) >= len(starts) - 2


def test_verdicts_do_not_depend_on_micro_batches(spark, tmp_path):
    lines, seen = traffic(seed=2), []
    for n in (2, 7):
        src, out = str(tmp_path / f"in{n}"), str(tmp_path / f"out{n}")
        put_files(src, cut(lines, n))
        stream = read_event_stream(spark, SourceConfig(format="json-files", path=src, max_files_per_trigger=1))
        start_window_detector(stream, CFG, out, str(tmp_path / f"ck{n}"), available_now=True).awaitTermination(600)
        seen.append(rows(spark.read.parquet(out)))
    assert seen[0] == seen[1] and seen[0]


def shuffled_batches(seed=5):
    """Batches in which a part of the messages comes one or two batches late."""
    rng = random.Random(seed)
    parts = cut(traffic(seed), 6)
    out = [[] for _ in range(8)]
    for b, part in enumerate(parts):
        for line in part:
            out[b + rng.choice([0] * 8 + [1, 2])].append(line)
    return [p for p in out if p]


def by_hand(spark, parts, delay, window):
    """(marks, late event ids by batch, on-time messages by window), one row at a time."""
    latest, marks, late, counts = None, [], {}, Counter()
    for b, part in enumerate(parts):
        got = [(r.event_id, r.us) for r in batch(spark, part).select("event_id", F.unix_micros("event_ts").alias("us")).collect()]
        wm = None if latest is None else latest - int(delay * 1e6)
        late[b] = sorted(i for i, us in got if us is not None and wm is not None and (us // (window * 10**6) + 1) * window * 10**6 <= wm)
        for i, us in got:
            if us is not None and i not in late[b]:
                counts[us // (window * 10**6) * window * 10**6] += 1
        latest = max([x for x in [latest, *(us for _, us in got)] if x is not None], default=None)
        marks.append((wm, latest, len(got), len(got) - len(late[b]), len(late[b]), b))
    return marks, late, counts, latest


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    parts = shuffled_batches()
    src, root = str(tmp_path / "in"), str(tmp_path / "t")
    put_files(src, parts)
    stream = read_event_stream(spark, SourceConfig(format="json-files", path=src, max_files_per_trigger=1), watermark=None)
    q = start_counted_rate(stream, root, str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    marks, late, counts, latest = by_hand(spark, parts, 60, 60)
    assert rows(late_marks(spark, root)) == sorted(marks, key=repr)
    got = {}
    for r in late_events(spark, root).collect():
        assert r.behind_us > 0
        got.setdefault(r.batch_id, []).append(r.event_id)
    assert {b: sorted(v) for b, v in got.items()} == {b: v for b, v in late.items() if v} and got
    m = late_marks(spark, root).agg(F.sum("input_rows"), F.sum("on_time_rows"), F.sum("late_rows")).first()
    assert m[0] == m[1] + m[2] == sum(map(len, parts))
    closed = {int(r.window_start.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6): r.messages
              for r in WindowCounts(root).closed(spark, 60).collect()}
    assert closed == {w: n for w, n in counts.items() if w + 60 * 10**6 <= latest - 60 * 10**6}


def test_a_replayed_batch_splits_as_it_did(spark, tmp_path):
    parts, root = shuffled_batches(6), str(tmp_path / "t")

    def run(split, upto, start=0):
        for b in range(start, upto):
            split(parse_events(messages_df(spark, parts[b]), keep_raw=True), b)

    run(LateSplit(WindowCounts(root), root), 4)
    before = rows(late_marks(spark, root)), rows(late_events(spark, root))

    class Broken(WindowCounts):
        def __call__(self, df, bid):
            super().__call__(df, bid)
            raise RuntimeError("cut off before the mark")

    with pytest.raises(RuntimeError):
        run(LateSplit(Broken(root), root), 5, 4)
    assert (rows(late_marks(spark, root)), rows(late_events(spark, root))) == before  # unmarked: not seen
    run(LateSplit(WindowCounts(root), root), 5, 3)  # and again, with the one before
    clean = str(tmp_path / "clean")
    run(LateSplit(WindowCounts(clean), clean), 5)
    assert rows(late_marks(spark, root)) == rows(late_marks(spark, clean))
    assert rows(late_events(spark, root)) == rows(late_events(spark, clean))
    assert rows(WindowCounts(root).closed(spark, 60)) == rows(WindowCounts(clean).closed(spark, 60))


def test_nothing_late_nothing_stored(spark, tmp_path):
    root = str(tmp_path / "t")
    assert late_marks(spark, root).count() == late_events(spark, root).count() == WindowCounts(root).closed(spark, 60).count() == 0
    LateSplit(WindowCounts(root), root)(batch(spark, [msg(0, "10.0.0.1", timestamp="x")]), 0)
    LateSplit(WindowCounts(root), root)(batch(spark, [msg(0, "10.0.0.1", 1.0)]), 1)
    second = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() + 1) * 10**6
    assert {r.batch_id: tuple(r)[:5] for r in late_marks(spark, root).collect()} == {0: (None, None, 1, 1, 0), 1: (None, second, 1, 1, 0)}


@pytest.mark.parametrize("span,every,chunk", [(60, 15, 4), (60, 15, 1024), (50, 20, 2), (10, 60, 3), (600, 7, 5)])
def test_trailing_rate_by_hand(spark, span, every, chunk):
    events = batch(spark, [*traffic(3, 60, 9), msg(90, "10.0.0.1", 0.0), msg(91, "10.0.0.1", 60.0), msg(92, "10.0.0.1", 5000.0)], keep_raw=False)
    us = [r[0] for r in events.select(F.unix_micros("event_ts")).collect() if r[0] is not None]
    got = {int(r.sample_ts.replace(tzinfo=dt.timezone.utc).timestamp() * 10**6): (r.messages, r.rate_per_sec)
           for r in trailing_rate(events, span, every, chunk).collect()}
    e, s = every * 10**6, span * 10**6
    seen = [u for u in us if -(-u // e) < -(-(u + s) // e)]  # some meet no sample where these are far apart
    lo, hi = min(-(-u // e) for u in seen), max(-(-(u + s) // e) for u in seen)
    want = {i * e: sum(u <= i * e < u + s for u in us) for i in range(lo, hi + 1)}
    assert got == {t: (n, n / span) for t, n in want.items()}
    assert 0 in want.values() and max(want.values()) > (1 if span > 10 else 0)


def test_trailing_rate_of_nothing(spark):
    assert trailing_rate(batch(spark, [msg(0, "10.0.0.1", timestamp="x")])).collect() == []


def test_trailing_rate_has_no_window_in_one_task(spark):
    plan = trailing_rate(fixture.clickstream_of(spark, SF["0.001"]))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("[chunk#" in line for line in windows)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_processing_time_trigger(spark, tmp_path):
    """The split and the detector under a processing-time trigger, files coming in between."""
    files = cut(traffic(8), 2)
    src, root, out = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "v")
    put_files(src, files[:1])

    def stream():
        return read_event_stream(spark, SourceConfig(format="json-files", path=src, max_files_per_trigger=1))

    scfg = StreamConfig(sink_root=root, checkpoint_location=str(tmp_path / "ck"), trigger_seconds=1)
    queries = [start_stream(stream(), CFG, scfg, FixedClock(dt.datetime(2026, 6, 18, 12))),
               start_window_detector(stream(), CFG, out, str(tmp_path / "vk"), trigger_seconds=1)]
    try:
        for q in queries:
            q.processAllAvailable()
        assert read_table(spark, root, "pipeline_metrics").count() == 1
        put_files(src, files[1:])
        for q in queries:
            q.processAllAvailable()
            assert q.isActive and q.exception() is None
    finally:
        for q in queries:
            q.stop()
    m = read_table(spark, root, "pipeline_metrics")
    assert sorted(r.batch_id for r in m.collect()) == [0, 1]
    assert m.agg(F.sum("total_events")).first()[0] == 300 and read_table(spark, root, "dead_letter").count() == 2
    events = batch(spark, sum(files, []), keep_raw=False).select(*EVENT_COLUMNS)
    want = shown(window_verdicts(events, CFG)).where(F.col("window_end") <= F.lit(watermark_of(events)))
    got = rows(spark.read.parquet(out))
    assert got and set(got) <= set(rows(want))
