"""Tables in buckets of their distribution column, content reconciliation, events without a time."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from surgeflow import fixture
from surgeflow.operators.partitioning import (bucket_placement, bucket_rows, content_differences, hash_distribution,
                                              product_activity, reconcile_content, reconcile_counts, write_distributed)
from surgeflow.plans.history import write_history
from surgeflow.plans.registry import _drop_distributed, _distributed, _tables
from surgeflow.schema import DISTRIBUTION_COLUMN
from surgeflow.session import drop_dir, scratch_dir
from surgeflow.sources.tables import read_table
from tests.conftest import SF


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_dir(spark, "stored")
    yield _distributed(spark, SF["0.01"], root)
    _drop_distributed(spark, root)
    drop_dir(spark, root)


def test_questions_on_the_distribution_column_exchange_nothing(spark, stored):
    by_ip = stored["events_flagged"].groupBy("ip_address").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("batch_id").alias("b"))
    for df in (product_activity(stored["events_clean"], stored["events_agg"]), by_ip,
               stored["events_clean"].join(stored["events_agg"], "product_id")):
        for hint in ("-1", "10485760"):  # whether small sides may be broadcast or not
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hint)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan, plan
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_same_answers_as_over_plain_tables(spark, stored):
    t = _tables(spark, SF["0.01"])
    assert rows(product_activity(stored["events_clean"], stored["events_agg"])) == rows(product_activity(t.clean, t.agg))
    for name, df in t.as_dict().items():
        if name in stored:
            assert stored[name].count() == df.count()


def test_real_buckets_are_those_of_the_hash(spark, stored):
    for name, col in DISTRIBUTION_COLUMN.items():
        want = {r.bucket: r.rows for r in hash_distribution(stored[name], col, fixture.N_SHARDS).collect()}
        assert {r.shard: r.rows for r in bucket_rows(stored[name], name).collect()} == want
        assert bucket_placement(stored[name], name, col, fixture.N_SHARDS).first()[2] == 0


def test_a_hot_key_fills_its_bucket_from_several_tasks(spark, tmp_path):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                             F.sha2(F.col("id").cast("string"), 256).alias("v"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = write_distributed(df, "t_hot", str(tmp_path / "hot"), "k", 4)
        hot = t.where("k = 'hot'").select(F.col("_metadata.file_name")).distinct().count()
        assert hot > 1 and t.count() == 60_000 and bucket_placement(t, "t", "k", 4).first()[2] == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS t_hot")
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


CONTENT = "k string, a string, b long"


def test_content_reconciliation_sees_what_counts_do_not(spark):
    before = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", None, 1), ("y", "1", None), ("z", "p", 1), ("z", "p", 1),
                                    ("w", "p", 1), (None, "p", 1), ("gone", "p", 1)], CONTENT)
    after = spark.createDataFrame([("x", "q", 2), ("x", "p", 1), ("y", "1", None), ("y", None, 2), ("z", "p", 1), ("z", "q", 1),
                                   ("w", "p", 1), (None, "p", 1), ("new", "p", 1)], CONTENT)
    report = reconcile_content(before, after, ["k"], ["k", "a", "b"])
    got = {r.k: (r.before_rows, r.after_rows, r.same) for r in report.where("k IS NOT NULL").collect()}
    assert got == {"x": (2, 2, True), "y": (2, 2, False), "z": (2, 2, False), "w": (1, 1, True), "gone": (1, 0, False), "new": (0, 1, False)}
    counts = reconcile_counts(before, after, ["k"]).where("k IN ('y', 'z')").collect()
    assert all(r.diff == 0 for r in counts)
    diff = content_differences(before, after, report, ["k"], ["k", "a", "b"])
    assert rows(diff) == sorted([("y", None, 1, -1), ("y", None, 2, 1), ("z", "p", 1, -1), ("z", "q", 1, 1), ("gone", "p", 1, -1), ("new", "p", 1, 1)], key=repr)


def test_nulls_do_not_stand_for_other_columns(spark):
    a = spark.createDataFrame([("k", None, 5)], "k string, a long, b long")
    b = spark.createDataFrame([("k", 5, None)], "k string, a long, b long")
    assert not reconcile_content(a, b, ["k"], ["a", "b"]).first().same


@pytest.fixture(scope="module")
def timeless(spark, tmp_path_factory):
    """sf0.001 with every 50th time missing."""
    path = tmp_path_factory.mktemp("timeless")
    raw = fixture.load(spark, SF["0.001"])
    raw.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts"))).coalesce(1).write.parquet(str(path / "events.parquet"))
    return str(path)


def test_backfill_sets_events_without_a_time_aside(spark, timeless, tmp_path):
    root = str(tmp_path / "t")
    for _ in range(2):  # again: nothing twice
        write_history(_tables(spark, timeless), root, str(tmp_path / "w"))
    dead = read_table(spark, root, "dead_letter").collect()
    assert len(dead) == 20 and {(r.error, r.batch_id) for r in dead} == {("event_ts", 0)}
    assert read_table(spark, root, "pipeline_metrics").agg(F.sum("total_events")).first()[0] == 980
    assert read_table(spark, root, "events_clean").count() + read_table(spark, root, "events_flagged").count() == 980


def test_queries_take_events_without_a_time(spark, timeless):
    split = queries()["micro_batch_split"](spark, timeless).collect()
    assert sum(r.total_events for r in split) == 980
    got = queries()["batch_pipeline"](spark, timeless).collect()
    n = {t: sum(r.n for r in got if r.table_name == t) for t in ("pipeline_metrics", "dead_letter")}
    assert n == {"pipeline_metrics": 980, "dead_letter": 20}
    assert {(r.batch_id, r.k2) for r in got if r.table_name == "dead_letter"} == {(0, "event_ts")}
