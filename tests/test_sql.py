"""The stored tables and the answers over them, as views for SQL users."""

import pytest

from surgeflow import fixture
from surgeflow.operators.aggregate import upsert_view
from surgeflow.plans import analytics as A
from surgeflow.plans.history import derive_tables, write_history
from surgeflow.sources.tables import read_table, register_views
from tests.conftest import SF


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sqltables"))
    raw = fixture.load(spark, SF["0.01"])
    t = derive_tables(fixture.clickstream(raw), fixture.FIXTURE_CONFIG, fixture.surrogate_stamps(raw), fixture.window_stamp())
    write_history(t, f"{root}/tables", f"{root}/work")
    register_views(spark, f"{root}/tables")
    return f"{root}/tables", t


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


QUESTIONS = {
    "top_products": lambda agg, m, f: A.top_products(agg),
    "throughput": lambda agg, m, f: A.throughput(m),
    "flagged_pct": lambda agg, m, f: A.flagged_pct(m),
    "top_offenders": lambda agg, m, f: A.top_offenders(f),
    "latency_distribution": lambda agg, m, f: A.latency_distribution(m),
    "minute_rollup": lambda agg, m, f: A.minute_rollup(m),
    "latest_batches": lambda agg, m, f: A.latest_batches(m),
    "latency_series": lambda agg, m, f: A.latency_series(m),
    "flagged_ip_series": lambda agg, m, f: A.flagged_ip_series(m),
}


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_stored_answers_equal_derived_ones(spark, stored, name):
    root, t = stored
    read = {n: read_table(spark, root, n) for n in ("events_agg", "pipeline_metrics", "events_flagged")}
    answer = QUESTIONS[name](upsert_view(read["events_agg"]), read["pipeline_metrics"], read["events_flagged"])
    assert rows(answer) == rows(QUESTIONS[name](t.agg, t.metrics, t.flagged))
    answer.createOrReplaceTempView(f"answer_{name}")
    assert rows(spark.table(f"answer_{name}")) == rows(answer)


def test_table_counts_over_stored_tables(spark, stored):
    root, t = stored
    read = {n: read_table(spark, root, n) for n in ("events_clean", "events_flagged", "pipeline_metrics")}
    read["events_agg"] = upsert_view(read_table(spark, root, "events_agg"))
    assert rows(A.table_counts(read)) == rows(A.verdict_counts(t.keyed, t.metrics))


def test_views_hold_committed_totals(spark, stored):
    assert spark.sql("SELECT SUM(total_events) FROM pipeline_metrics").first()[0] == 10000
    assert spark.sql("SELECT COUNT(*) FROM events_flagged").first()[0] == 776
    assert spark.sql("SELECT SUM(event_count) FROM events_agg").first()[0] == 9224
