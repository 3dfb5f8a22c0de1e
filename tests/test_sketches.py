"""Summaries that merge over batches, and what write jobs observe, against exact counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from surgeflow.config import FixedClock
from surgeflow.plans import sketches as K
from surgeflow.sources.sinks import read_report, reconcile_written
from surgeflow.sources.tables import read_table
from surgeflow.streaming import BatchProcessor
from tests.helpers import DEFAULT, T0, batch, msg, spread


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """20 batches of events with skewed IPs: (counts, waits, summaries), stored."""
    rng = random.Random(4)
    rows = [(b, f"10.{min(255, int(rng.paretovariate(0.7)))}.{rng.randrange(200)}", T0 + dt.timedelta(minutes=b, milliseconds=rng.randrange(60_000)))
            for b in range(20) for _ in range(1500)]
    path = tmp_path_factory.mktemp("sketches")
    ev = spark.createDataFrame(rows, "batch_id long, ip_address string, event_ts timestamp")
    ev.write.parquet(str(path / "events"))
    ev = spark.read.parquet(str(path / "events"))
    counts = ev.groupBy("batch_id", "ip_address").agg(F.count(F.lit(1)).alias("n"))
    waits = K.with_wait(ev, ev.groupBy("batch_id").agg(F.max("event_ts").alias("max_ts")))
    K.batch_summaries(waits, counts).write.parquet(str(path / "summaries"))
    return counts, waits, spark.read.parquet(str(path / "summaries"))


PICKS = {"all": "true", "one": "batch_id = 3", "some": "batch_id % 3 = 1", "two ends": "batch_id IN (0, 19)"}


@pytest.mark.parametrize("pick", PICKS)
def test_distinct_ips_over_any_batches(data, pick):
    counts, _, summaries = data
    group = F.lit(0)
    exact = K.distinct_exact(counts.where(PICKS[pick]), group).first().distinct_ips
    got = K.distinct_estimate(summaries.where(PICKS[pick]), group).first().estimate
    assert abs(got - exact) <= 0.03 * exact + 1 and exact > 300


@pytest.mark.parametrize("pick", PICKS)
def test_quantiles_over_any_batches(data, pick):
    _, waits, summaries = data
    guess = K.quantile_estimates(summaries.where(PICKS[pick]), F.lit(0)).first()
    exact = K.quantiles_exact(waits.where(PICKS[pick]), F.lit(0)).first()
    w = sorted(r[0] for r in waits.where(PICKS[pick]).select("wait_ms").collect())
    for name, q in K.QUANTILES.items():
        assert abs(sum(x <= guess[name] for x in w) / len(w) - q) <= 0.01
        assert exact[name] == w[min(len(w) - 1, -(-len(w) * q // 1).__int__() - 1)]


@pytest.mark.parametrize("pick", PICKS)
@pytest.mark.parametrize("counters", [500, 40, 2])
def test_heavy_hitters_are_exact(data, pick, counters):
    """Proven by the summaries, or counted over all IPs where they prove nothing."""
    counts, waits, _ = data
    summaries = K.batch_summaries(waits, counts, counters).where(PICKS[pick])
    assert summaries.agg(F.max(F.size("heavy"))).first()[0] is None or summaries.agg(F.max(F.size("heavy"))).first()[0] <= counters
    got = [tuple(r) for r in K.heavy_hitters(counts, summaries, 10, counters).collect()]
    want = (counts.where(PICKS[pick]).groupBy("ip_address").agg(F.sum("n").alias("e"), F.count(F.lit(1)).alias("b"))
            .orderBy(F.desc("e"), "ip_address").limit(10).collect())
    assert got == [tuple(r) for r in want]


def test_summaries_of_nothing(data):
    counts, _, summaries = data
    none = summaries.where("false")
    assert K.distinct_estimate(none, F.lit(0)).collect() == [] and K.heavy_hitters(counts, none).collect() == []


def test_observed_writes_equal_the_stored_rows(spark, sink_root):
    """After a batch that failed behind its writes and was replayed with fewer rows."""
    clock = FixedClock(dt.datetime(2026, 6, 18, 12))
    first = spread(60, "10.0.0.1", 2.0) + [msg(100 + i, f"10.0.1.{i}", i / 7) for i in range(15)]
    with pytest.raises(RuntimeError):
        BatchProcessor(DEFAULT, sink_root, clock, fail_after="events_agg", report=True)(batch(spark, first), 0)
    assert read_report(spark, sink_root).count() == 0
    run = BatchProcessor(DEFAULT, sink_root, clock, report=True)
    run(batch(spark, first[:-4]), 0)
    run(batch(spark, [msg(0, "10.0.0.9", 1.0), msg(1, "10.0.0.9", 2.0, product_id=None)]), 1)
    got = {(r.batch_id, r.table_name): (r.written_rows, r.stored_rows, r.same) for r in reconcile_written(spark, sink_root).collect()}
    assert got == {(0, "events_clean"): (11, 11, True), (0, "events_flagged"): (60, 60, True),
                   (1, "events_clean"): (1, 1, True), (1, "events_flagged"): (0, 0, True)}
    m = {r.batch_id: (r.legit_events, r.flagged_events) for r in read_table(spark, sink_root, "pipeline_metrics").collect()}
    assert m == {b: (got[b, "events_clean"][0], got[b, "events_flagged"][0]) for b in (0, 1)}


def test_a_lost_row_shows(spark, sink_root):
    run = BatchProcessor(DEFAULT, sink_root, FixedClock(dt.datetime(2026, 6, 18, 12)), report=True)
    run(batch(spark, [msg(i, "10.0.0.9", i) for i in range(5)]), 0)
    path = f"{sink_root}/events_clean/batch_id=0"
    kept = spark.createDataFrame(spark.read.parquet(path).limit(4).collect(), spark.read.parquet(path).schema)
    kept.write.mode("overwrite").parquet(path)
    assert [r.same for r in reconcile_written(spark, sink_root).where("table_name = 'events_clean'").collect()] == [False]
