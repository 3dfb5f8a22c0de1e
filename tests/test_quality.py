"""Evaluation operators on constructed event sets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from surgeflow.operators.partitioning import hash_distribution, reconcile_counts
from surgeflow.plans.quality import action_mix, detection_accuracy, rate_conformance

START = dt.datetime(2026, 1, 1)


def uniform_events(spark, eps, seconds):
    """int(eps x seconds) events spread evenly over the phase."""
    n = int(eps * seconds)
    step_us = seconds * 1_000_000 / max(n, 1)
    return (spark.range(n)
            .select((F.lit(START).cast("timestamp")
                     + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                          (F.col("id") * F.lit(step_us) / F.lit(1e6)).cast("decimal(18,6)")))
                    .alias("event_ts")))


def phases(spark, seconds, eps):
    return spark.createDataFrame(
        [(0, START, START + dt.timedelta(seconds=seconds), float(eps))],
        "phase_id long, start_ts timestamp, end_ts timestamp, eps double")


# The generator's rate cases (events/s, seconds), tolerance 1 %.
@pytest.mark.parametrize("eps,seconds", [(100, 120), (10000, 30), (1, 10), (0.5, 20), (100000, 5)])
def test_rate_conformance_cases(spark, eps, seconds):
    r = rate_conformance(uniform_events(spark, eps, seconds), phases(spark, seconds, eps)).first()
    assert r["actual"] == int(eps * seconds)
    assert r["within_tol"], r


def test_rate_conformance_detects_shortfall(spark):
    r = rate_conformance(uniform_events(spark, 90, 120), phases(spark, 120, 100)).first()
    assert not r["within_tol"] and abs(r["rel_error"] - 0.1) < 1e-9


def test_detection_accuracy_counts(spark):
    ev = spark.createDataFrame(
        [(0, "a", True)] * 5 + [(0, "b", False)] * 3 + [(0, "c", True)] * 2,
        "batch_id long, ip_address string, lbl boolean")
    rates = spark.createDataFrame([(0, "a", True), (0, "b", True), (0, "c", False)],
                                  "batch_id long, ip_address string, is_bot boolean")
    r = detection_accuracy(ev, rates, "lbl").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (5, 3, 2, 0)
    assert r["precision"] == 0.625 and r["recall"] == round(5 / 7, 4)


def test_action_mix_shares(spark):
    ev = spark.createDataFrame([("bot", "PURCHASE")] * 7 + [("bot", "VIEW")] * 3,
                               "traffic_class string, action string")
    rows = {r["action"]: r for r in action_mix(ev).collect()}
    assert rows["PURCHASE"]["share"] == 0.7 and rows["PURCHASE"]["expected_share"] == 0.7
    assert rows["VIEW"]["expected_share"] == 0.1


def test_reconcile_counts(spark):
    before = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    after = spark.createDataFrame([(1,), (3,)], "k long")
    got = {r["k"]: (r["before_rows"], r["after_rows"], r["diff"])
           for r in reconcile_counts(before, after, ["k"]).collect()}
    assert got == {1: (2, 1, -1), 2: (1, 0, -1), 3: (0, 1, 1)}


def test_hash_distribution_matches_repartition(spark):
    df = spark.range(1000).select(F.format_string("ip%d", F.col("id") % 37).alias("ip"))
    want = {r["bucket"]: r["rows"] for r in hash_distribution(df, "ip", 8).collect()}
    got = (df.repartition(8, "ip").withColumn("p", F.spark_partition_id())
           .groupBy("p").count().collect())
    assert {r["p"]: r["count"] for r in got} == want


def test_rate_conformance_sub_second_phase_bounds(spark):
    start, end = START + dt.timedelta(milliseconds=500), START + dt.timedelta(seconds=2, milliseconds=500)
    ev = spark.createDataFrame([(START + dt.timedelta(milliseconds=m),) for m in (100, 600, 900, 2400, 2600)],
                               "event_ts timestamp")
    ph = spark.createDataFrame([(0, start, end, 1.5)], "phase_id long, start_ts timestamp, end_ts timestamp, eps double")
    r = rate_conformance(ev, ph).first()
    assert r["actual"] == 3 and r["expected"] == 3.0 and r["within_tol"]


def test_rate_conformance_phase_ending_past_a_bucket_edge(spark):
    start, end = START, START + dt.timedelta(seconds=3600, milliseconds=500)
    ev = spark.createDataFrame([(START + dt.timedelta(seconds=3600, milliseconds=200),),
                                (START + dt.timedelta(seconds=10),)], "event_ts timestamp")
    ph = spark.createDataFrame([(0, start, end, None)], "phase_id long, start_ts timestamp, end_ts timestamp, eps double")
    r = rate_conformance(ev, ph).first()
    assert r["actual"] == 2 and abs(r["expected"] - 2.0) < 1e-9


def test_rate_conformance_to_the_microsecond(spark):
    start, end = START + dt.timedelta(milliseconds=500), START + dt.timedelta(milliseconds=2500)
    at = [500_000 - 1, 500_000, 800_000, 1_200_000, 1_700_000, 2_499_999, 2_500_000, 2_900_000]
    ev = spark.createDataFrame([(START + dt.timedelta(microseconds=m),) for m in at], "event_ts timestamp")
    ph = spark.createDataFrame([(0, start, end, 2.5)], "phase_id long, start_ts timestamp, end_ts timestamp, eps double")
    for seconds in (1, 3600):
        r = rate_conformance(ev, ph, bucket_seconds=seconds).first()
        assert r["actual"] == 5 and r["expected"] == 5.0 and r["within_tol"]


def test_rate_conformance_without_target_or_events(spark):
    r = rate_conformance(uniform_events(spark, 1, 10), phases(spark, 10, 0)).first()
    assert (r["expected"], r["actual"], r["rel_error"], r["within_tol"]) == (0.0, 10, 0.0, True)
    none = spark.createDataFrame([], "event_ts timestamp")
    ph = spark.createDataFrame([(0, START, START + dt.timedelta(seconds=5), None)],
                               "phase_id long, start_ts timestamp, end_ts timestamp, eps double")
    r = rate_conformance(none, ph).first()
    assert (r["expected"], r["actual"], r["rel_error"]) == (0.0, 0, 0.0)


def test_shards_take_any_key_and_are_all_used(spark):
    from surgeflow.operators.partitioning import placement, shard_distribution, shard_rows
    ips = spark.range(40320).select(F.concat_ws(".", F.lit("10"), (F.col("id") / 256 % 8).cast("int").cast("string"),
                                                (F.col("id") % 256).cast("string"), (F.col("id") % 7).cast("string")).alias("ip"))
    used = shard_rows(ips, "t", "ip", 32).collect()
    assert {r["shard"] for r in used} == set(range(32)) and sum(r["rows"] for r in used) == 40320
    odd = spark.createDataFrame([("sku-a",), ("",), ("é",)], "k string")
    got = shard_distribution([shard_rows(odd, "t", "k", 32)], placement(spark, 32, 3)).collect()
    assert sum(r["row_count"] for r in got) == 3
