"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the flagship at sf0.001."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, duck
from surgeflow.plans.registry import QUERIES
from tests.conftest import SF

KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF["0.01"])


def test_every_engine_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, queries()[key], oracle_sql()[key], SF["0.01"], con)
    assert r["ok"], r


def test_micro_batches_before_the_first_day(spark, tmp_path):
    from surgeflow import fixture
    early = fixture.load(spark, SF["0.001"]).selectExpr("event_id", "ts - INTERVAL 12 DAYS AS ts", "user_id", "event_type", "value", "props")
    early.coalesce(1).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    got = [r for r in queries()["batch_pipeline"](spark, str(tmp_path / "sf")).collect() if r.table_name == "pipeline_metrics"]
    assert sum(r.n for r in got) == 1000 and min(r.batch_id for r in got) == -3


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 30
    assert sum(r["total_events"] for r in rows) == 1000
    assert sum(r["flagged_events"] for r in rows) == 103


@pytest.mark.parametrize("sf,total,clean,flagged,pairs", [
    ("0.001", 1000, 897, 103, 17), ("0.01", 10000, 9224, 776, 122)])
def test_target_numbers(spark, sf, total, clean, flagged, pairs):
    from surgeflow.plans.registry import _tables
    t = _tables(spark, SF[sf])
    m = t.metrics.agg({"total_events": "sum", "legit_events": "sum", "flagged_events": "sum",
                       "distinct_flagged_ips": "sum"}).first()
    assert m["sum(total_events)"] == total
    assert m["sum(legit_events)"] == clean
    assert m["sum(flagged_events)"] == flagged
    assert m["sum(distinct_flagged_ips)"] == pairs
