"""Plan-shape guards for every registered query (scale properties).

No cartesian product or nested-loop join, no Python evaluation in the plan,
scans read only the columns they need, and aggregates are two-phase (partial
before the shuffle).
"""

import pytest

from __spark_entry__ import queries
from surgeflow.plans.registry import QUERIES
from tests.conftest import SF

KEYS = sorted(QUERIES)
# The queries that write through the table protocol run it while building.
WRITERS = {"upsert_events_agg", "micro_batch_split", "batch_pipeline", "dead_letters", "conservation", "table_counts", "window_detector",
           "late_rows", "product_activity", "bucket_placement", "distinct_ips", "wait_quantiles", "heavy_hitters", "written_rows",
           "stored_answers", "rate_conformance",
           "shard_distribution", "reconcile_counts"}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_text(queries()[k](spark, SF["0.001"])) for k in KEYS}


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_or_nested_loop(plans, key):
    p = plans[key]
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, p


@pytest.mark.parametrize("key", KEYS)
def test_no_python_in_plan(plans, key):
    p = plans[key]
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p, (key, node)


@pytest.mark.parametrize("key", KEYS)
def test_two_phase_aggregation(spark, key):
    if key in WRITERS:
        pytest.skip("reads back written tables")
    df = queries()[key](spark, SF["0.001"])
    p = df._jdf.queryExecution().optimizedPlan().toString()
    if "Aggregate" not in p:
        pytest.skip("no aggregate")
    phys = plan_text(df)
    assert "partial_" in phys or "Distinct" in phys, phys


def test_batch_metrics_scan_is_pruned(spark):
    df = queries()["batch_metrics"](spark, SF["0.001"])
    p = plan_text(df)
    # ts, user_id, event_type (validation of action) and event_id (surrogate
    # stamp) at most; never the JSON props or the value column
    for line in p.splitlines():
        if "FileScan parquet" in line:
            schema = line.split("ReadSchema:")[1]
            assert "props" not in schema and "value" not in schema, schema


def event_scans(df) -> int:
    df.collect()
    final = plan_text(df).split("Initial Plan")[0]
    return sum("FileScan parquet" in line and "events.parquet" in line for line in final.splitlines())


@pytest.mark.parametrize("key,most", [("ip_rate", 2), ("batch_metrics", 2), ("batch_span", 1), ("flagged_events", 3)])
def test_scans_of_lazy_plans(spark, key, most):
    assert event_scans(queries()[key](spark, SF["0.001"])) <= most


@pytest.mark.parametrize("key,most", [("conservation", 1), ("table_counts", 1), ("shard_distribution", 1),
                                      ("reconcile_counts", 2)])
def test_scans_beside_the_one_that_counts(spark, tmp_path, key, most):
    from surgeflow.plans.registry import SETTLED, _tables
    t = _tables(spark, SF["0.001"]).settle(str(tmp_path / "counts"))
    assert event_scans(SETTLED[key](spark, SF["0.001"], t)) <= most


def test_rate_conformance_reads_the_events_three_times(spark, tmp_path):
    from surgeflow import fixture
    from surgeflow.plans.quality import conformance_of, phase_counts
    events, path = fixture.clickstream_of(spark, SF["0.001"]), str(tmp_path / "phases")
    phases = fixture.day_phases(events)
    assert event_scans(phases) == 1
    phases.write.parquet(path)
    counts = phase_counts(events, spark.read.parquet(path))
    assert event_scans(counts) == 2
    counts.write.parquet(str(tmp_path / "counts"))
    assert event_scans(conformance_of(spark.read.parquet(str(tmp_path / "counts")))) == 0


def test_one_huge_batch_is_many_tasks(spark):
    """Joined by batch and salt, the aggregate per batch combines first and exchanges a row per salt."""
    from pyspark.sql import functions as F

    from surgeflow.config import DetectorConfig
    from surgeflow.operators.detect import batch_metrics, rates_of
    counts = spark.range(0, 200_000, 1, 8).select(F.lit(1).cast("long").alias("batch_id"), F.col("id").cast("string").alias("ip_address"),
                                                  F.lit(1).cast("long").alias("n"), F.current_timestamp().alias("min_ts"), F.current_timestamp().alias("max_ts"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # spans too many to be broadcast
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rates = rates_of(counts, DetectorConfig())
        used = rates.groupBy(F.spark_partition_id()).count().count()
        m = batch_metrics(rates)
        assert used > 1 and "partial_sum" in plan_text(m) and m.first()["total_events"] == 200_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_message_rate_single_scan_partial_agg(spark):
    p = plan_text(queries()["message_rate"](spark, SF["0.001"]))
    assert p.count("FileScan parquet") == 1
    assert "partial_count" in p


def test_committed_read_prunes_batch_directories(spark, tmp_path):
    from surgeflow.plans.registry import _tables
    from surgeflow.sources.sinks import write_batches
    from surgeflow.sources.tables import read_table
    root = str(tmp_path / "t")
    t = _tables(spark, SF["0.001"])
    write_batches(t.clean, root, "events_clean")
    write_batches(t.metrics.filter("batch_id < 5"), root, "pipeline_metrics")
    df = read_table(spark, root, "events_clean")
    assert {r[0] for r in df.select("batch_id").distinct().collect()} <= set(range(5))
    assert "dynamicpruningexpression(batch_id" in plan_text(df)
