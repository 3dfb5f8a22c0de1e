"""Registered queries: one per operator key, over the driver's test tables.

Each takes (spark, sf_dir) and returns a lazy DataFrame built from the
``events`` table through the fixture mapping and the same functions the
streaming job uses, over all batches at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow import fixture
from surgeflow.functions.columns import ntz
from surgeflow.operators.aggregate import upsert_view
from surgeflow.config import FixedClock
from surgeflow.operators.detect import batch_metrics, batch_span, conservation, flag_reason, spans_of, verdict_rows
from surgeflow.operators.partitioning import (bucket_placement, content_differences, placement, product_activity,
                                              reconcile_content, reconcile_counts, shard_distribution, shard_rows,
                                              write_distributed)
from surgeflow.plans import analytics as A
from surgeflow.plans import quality as Q
from surgeflow.plans.history import Tables, derive_tables, write_history
from surgeflow.plans.sketches import (QUANTILES, batch_summaries, distinct_estimate, distinct_exact, heavy_hitters, quantile_estimates,
                                      quantiles_exact, with_wait)
from surgeflow.plans.windows import shown, trailing_rate, window_metrics, window_verdicts
from surgeflow.schema import DISTRIBUTION_COLUMN, EVENT_COLUMNS, METRIC_COLUMNS
from surgeflow.session import drop_dir, scratch_dir
from surgeflow.sources.messages import encode_messages, parse_events, with_validation
from surgeflow.sources.sinks import reconcile_written, write_batches
from surgeflow.sources.tables import TABLES, read_raw_table, read_table
from surgeflow.streaming.micro_batch import BatchProcessor
from surgeflow.streaming.windows import LateSplit, WindowCounts, late_events, late_marks, start_window_detector

CFG = fixture.FIXTURE_CONFIG


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.clickstream_of(spark, sf)


def _tables(spark: SparkSession, sf: str) -> Tables:
    raw = fixture.load(spark, sf)
    return derive_tables(fixture.clickstream(raw), CFG, fixture.surrogate_stamps(raw),
                         fixture.window_stamp())


def _out_events(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    cols = [F.col(c) for c in EVENT_COLUMNS[:5]] + [ntz("event_ts").alias("event_ts")]
    return df.select(*cols, *extra)


def _messages(spark, sf):
    return encode_messages(_events(spark, sf).select(*EVENT_COLUMNS))


def q_encode_messages(spark, sf):
    return _messages(spark, sf).select(F.col("key").cast("string").alias("key"),
                                       F.col("value").cast("string").alias("value"))


def q_parse_events(spark, sf):
    return _out_events(parse_events(_messages(spark, sf)))


def q_validate_events(spark, sf):
    """Messages of which some lack a required field."""
    sent = encode_messages(fixture.some_invalid(_events(spark, sf).select(*EVENT_COLUMNS)))
    return _out_events(with_validation(parse_events(sent)), ["error"])


def q_batch_span(spark, sf):
    return (batch_span(_tables(spark, sf).events, CFG)
            .select("batch_id", "total_events", ntz("min_ts").alias("min_ts"),
                    ntz("max_ts").alias("max_ts"), "raw_span_sec", "span_sec", "threshold"))


def q_ip_rate(spark, sf):
    return _tables(spark, sf).rates.drop("reason")


def q_flag_reason(spark, sf):
    return flag_reason(_tables(spark, sf).rates)


def q_flagged_events(spark, sf):
    return _out_events(_tables(spark, sf).flagged, ["batch_id", "reason"])


def q_clean_events(spark, sf):
    return _out_events(_tables(spark, sf).clean, ["batch_id"])


def q_events_agg(spark, sf):
    t = _tables(spark, sf)
    return t.agg_deltas.select("batch_id", ntz("window_start").alias("window_start"), "product_id",
                               "action", "event_count")


def _kept(spark, root: str, df: DataFrame) -> DataFrame:
    """The result, written and read back; the work and tables it came from go."""
    df.write.parquet(f"{root}/result")
    for part in ("work", "tables"):
        drop_dir(spark, f"{root}/{part}")
    return spark.read.schema(df.schema).parquet(f"{root}/result")


def q_upsert_events_agg(spark, sf):
    """Deltas go through the sink (one directory per batch, dynamic
    overwrite) twice, as a replay of every batch would, and are read back
    through the additive view: batches of one minute add up, the replay adds
    nothing. The deltas are computed once into a work table."""
    root = scratch_dir(spark, "upsert")
    _tables(spark, sf).agg_deltas.write.parquet(f"{root}/work/deltas")
    deltas = spark.read.parquet(f"{root}/work/deltas")
    write_batches(deltas, f"{root}/tables", "events_agg")
    write_batches(deltas, f"{root}/tables", "events_agg")
    view = upsert_view(read_raw_table(spark, f"{root}/tables", "events_agg"))
    return _kept(spark, root, view.select(ntz("window_start").alias("window_start"), "product_id", "action", "event_count"))


def q_batch_metrics(spark, sf):
    return batch_metrics(_tables(spark, sf).rates)


def conservation_of(spark, sf, t: Tables) -> DataFrame:
    return conservation(batch_metrics(t.rates), verdict_rows(t.verdicts))


def table_counts_of(spark, sf, t: Tables) -> DataFrame:
    return A.verdict_counts(t.keyed, batch_metrics(t.rates))


def shard_distribution_of(spark, sf, t: Tables) -> DataFrame:
    """Clean rows and aggregate keys from one pass over the verdicts, flagged
    rows from the per-IP counts."""
    n, at = fixture.N_SHARDS, DISTRIBUTION_COLUMN
    parts = [shard_rows(t.keyed, "events_clean", at["events_clean"], n, F.col("clean_rows")),
             shard_rows(t.rates.filter("is_bot"), "events_flagged", at["events_flagged"], n, F.col("n")),
             shard_rows(t.keyed.filter("clean_rows > 0"), "events_agg", at["events_agg"], n)]
    return shard_distribution(parts, placement(spark, n, fixture.N_NODES))


def reconcile_counts_of(spark, sf, t: Tables) -> DataFrame:
    """Source rows per batch against rows landed in clean + flagged."""
    return reconcile_counts(_events(spark, sf).select("batch_id"), t.verdicts.select("batch_id"), ["batch_id"])


# Questions that use the rule's verdicts several times, from counts written once.
SETTLED = {"conservation": conservation_of, "table_counts": table_counts_of,
           "shard_distribution": shard_distribution_of, "reconcile_counts": reconcile_counts_of}


def _settled(name: str):
    def query(spark, sf):
        root = scratch_dir(spark, name)
        return _kept(spark, root, SETTLED[name](spark, sf, _tables(spark, sf).settle(f"{root}/work/counts")))
    return query


def q_micro_batch_split(spark, sf):
    """The whole split backfilled through the replay-safe table protocol
    (verdicts once, data tables, metrics last as the commit mark) and read
    back committed: each batch's metrics beside the rows its tables hold."""
    root = scratch_dir(spark, "split")
    try:
        write_history(_tables(spark, sf), f"{root}/tables", f"{root}/work")
    except BaseException:
        drop_dir(spark, root)
        raise

    def stored(table, n, name):
        return read_table(spark, f"{root}/tables", table).groupBy("batch_id").agg(n.cast("long").alias(name))

    out = read_table(spark, f"{root}/tables", "pipeline_metrics").select(
        *[ntz(c).alias(c) if c == "batch_ts" else F.col(c) for c in METRIC_COLUMNS])
    for table, n, name in (("events_clean", F.count(F.lit(1)), "clean_rows"), ("events_flagged", F.count(F.lit(1)), "flagged_rows"),
                           ("events_agg", F.sum("event_count"), "agg_events")):
        out = out.join(stored(table, n, name), "batch_id", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return _kept(spark, root, out)


def _runs(spark, path: str, events: DataFrame) -> tuple[DataFrame, list[int]]:
    """Events written by ``run``, their micro-batch, and the runs there are (one number
    each). Events of no run, as they have no time, come with the first."""
    first = F.coalesce(events.agg(F.min("run")).scalar(), F.lit(0).cast("long"))
    events.select(*EVENT_COLUMNS, F.coalesce("run", first).alias("run")).write.partitionBy("run").parquet(path)
    runs = spark.read.schema(events.select(*EVENT_COLUMNS, "run").schema).parquet(path)
    return runs, sorted(r[0] for r in runs.select("run").distinct().collect())


def _processed(spark, root: str, events: DataFrame, cfg, report: bool = False) -> None:
    """Every run of ``events`` through the per-batch function, as messages."""
    runs, present = _runs(spark, f"{root}/work/runs", events)
    process = BatchProcessor(cfg, f"{root}/tables", FixedClock(dt.datetime(2024, 2, 1)), report=report)
    for b in present:
        process(parse_events(encode_messages(runs.where(F.col("run") == b).select(*EVENT_COLUMNS)), keep_raw=True), b)


def q_dead_letters(spark, sf):
    """Micro-batches some of whose messages lack a field: what the per-batch function
    sets aside, and why, beside the valid events that it counts."""
    root = scratch_dir(spark, "dead")
    events = _events(spark, sf).withColumn("run", F.floor(F.col("batch_id") / fixture.DEAD_LETTER_DAYS))
    _processed(spark, root, fixture.some_invalid(events), fixture.PIPELINE_CONFIG)
    dead = read_table(spark, f"{root}/tables", "dead_letter").groupBy("batch_id", "error").agg(
        F.count(F.lit(1)).alias("messages"), F.count("raw").alias("with_raw"))
    valid = read_table(spark, f"{root}/tables", "pipeline_metrics").select(
        "batch_id", F.lit(None).cast("string").alias("error"), F.col("total_events").alias("messages"), F.lit(0).cast("long").alias("with_raw"))
    return _kept(spark, root, dead.unionByName(valid))


def q_batch_pipeline(spark, sf):
    """The per-batch function over real micro-batches of several days each, and
    the rows of all stored tables, dead letters included."""
    root = scratch_dir(spark, "batches")
    events = _events(spark, sf)
    _processed(spark, root, events.withColumn("run", F.floor(F.col("batch_id") / fixture.PIPELINE_DAYS)), fixture.PIPELINE_CONFIG)

    def table(name):
        return read_table(spark, f"{root}/tables", name)

    def rows(df, name, batch, keys, n):
        text = [k.cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
        return df.select(F.lit(name).alias("table_name"), batch.cast("long").alias("batch_id"),
                         *[k.alias(f"k{i}") for i, k in enumerate(text)], n.cast("long").alias("n"))

    c = F.col
    out = rows(table("events_clean"), "events_clean", c("batch_id"), [c("event_id"), c("ip_address")], F.lit(1))
    out = out.unionByName(rows(table("events_flagged"), "events_flagged", c("batch_id"),
                               [c("event_id"), c("ip_address"), c("reason")], F.lit(1)))
    out = out.unionByName(rows(upsert_view(table("events_agg")), "events_agg", F.lit(None),
                               [c("product_id"), c("action")], c("event_count")))
    out = out.unionByName(rows(table("pipeline_metrics"), "pipeline_metrics", c("batch_id"),
                               [c("legit_events"), c("flagged_events"), c("distinct_flagged_ips")], c("total_events")))
    out = out.unionByName(rows(table("dead_letter"), "dead_letter", c("batch_id"), [c("event_id"), c("ip_address"), c("error")], F.lit(1)))
    return _kept(spark, root, out)


def q_top_products(spark, sf):
    return A.top_products(_tables(spark, sf).agg)


def q_throughput(spark, sf):
    return A.throughput(_tables(spark, sf).metrics)


def q_flagged_pct(spark, sf):
    return A.flagged_pct(_tables(spark, sf).metrics)


def q_top_offenders(spark, sf):
    return A.top_offenders(_tables(spark, sf).flagged)


def q_latency_distribution(spark, sf):
    return A.latency_distribution(_tables(spark, sf).metrics)


def q_minute_rollup(spark, sf):
    return A.minute_rollup(_tables(spark, sf).metrics)


def q_latest_batches(spark, sf):
    return A.latest_batches(_tables(spark, sf).metrics)


def q_latency_series(spark, sf):
    return A.latency_series(_tables(spark, sf).metrics)


def q_flagged_ip_series(spark, sf):
    return A.flagged_ip_series(_tables(spark, sf).metrics)


def q_message_rate(spark, sf):
    return A.message_rate(_events(spark, sf), 60)


def q_detection_accuracy(spark, sf):
    t = _tables(spark, sf)
    ev = t.events.withColumn("is_bot_label", fixture.is_bot_label())
    return Q.detection_accuracy(ev, t.rates, "is_bot_label")


def q_rate_conformance(spark, sf):
    """Phases and their counts are stored in turn: three scans of the events in all."""
    root = scratch_dir(spark, "conformance")
    events = _events(spark, sf)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/work/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/work/{name}")

    phases = stored(fixture.day_phases(events), "phases")
    return _kept(spark, root, Q.conformance_of(stored(Q.phase_counts(events, phases), "counts"), tol=0.01))


def q_action_mix(spark, sf):
    ev = _events(spark, sf).withColumn(
        "traffic_class", F.when(fixture.is_bot_label(), F.lit("bot")).otherwise(F.lit("normal")))
    return Q.action_mix(ev, "traffic_class")


def q_window_verdicts(spark, sf):
    return shown(window_verdicts(_events(spark, sf), fixture.WINDOW_CONFIG, fixture.WINDOW_SECONDS))


def q_window_metrics(spark, sf):
    verdicts = window_verdicts(_events(spark, sf), fixture.WINDOW_CONFIG, fixture.WINDOW_SECONDS)
    return window_metrics(verdicts, fixture.WINDOW_SECONDS)


def q_window_detector(spark, sf):
    """The detector as a stream over the events table: what it appends for the windows
    that the watermark closes, once every file has been read."""
    root = scratch_dir(spark, "detector")
    raw = spark.readStream.schema(fixture.EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet").option(
        "recursiveFileLookup", "true").parquet(f"{sf.rstrip('/')}/events*.parquet")
    stream = fixture.clickstream(raw).withWatermark("event_ts", "1 minute")
    query = start_window_detector(stream, fixture.WINDOW_CONFIG, f"{root}/tables/verdicts", f"{root}/work/checkpoint",
                                  fixture.WINDOW_SECONDS, available_now=True)
    query.awaitTermination()
    return _kept(spark, root, spark.read.parquet(f"{root}/tables/verdicts"))


def q_late_rows(spark, sf):
    """Micro-batches of which some rows come late, through the side path: what each
    batch's watermark let pass, and every late row with how far it is behind."""
    root = scratch_dir(spark, "late")
    runs, present = _runs(spark, f"{root}/work/runs", fixture.arrivals(_events(spark, sf)))
    split = LateSplit(WindowCounts(f"{root}/tables", fixture.WINDOW_SECONDS), f"{root}/tables", fixture.LATE_DELAY_SECONDS,
                      fixture.WINDOW_SECONDS)
    for i, run in enumerate(present):
        split(runs.where(F.col("run") == run).drop("run"), i)
    c, none = F.col, F.lit(None)
    marks = late_marks(spark, f"{root}/tables").select(
        F.lit("batch").alias("kind"), "batch_id", none.cast("string").alias("event_id"), "input_rows", "on_time_rows", "late_rows",
        none.cast("long").alias("behind_us"))
    late = late_events(spark, f"{root}/tables").select(
        F.lit("late").alias("kind"), "batch_id", "event_id", *[none.cast("long").alias(x) for x in ("input_rows", "on_time_rows", "late_rows")],
        c("behind_us"))
    return _kept(spark, root, marks.unionByName(late).withColumn("batch_id", c("batch_id").cast("long")))


def q_trailing_rate(spark, sf):
    return trailing_rate(_events(spark, sf), fixture.TRAILING_SECONDS, fixture.SAMPLE_SECONDS)


def _distributed(spark, sf, root: str) -> dict[str, DataFrame]:
    """The three distributed tables, each stored in buckets of its distribution column."""
    t = _tables(spark, sf).settle(f"{root}/work/counts")
    name = "t_" + root.rsplit("-", 1)[-1]
    return {table: write_distributed(t.as_dict()[table], f"{name}_{table}", f"{root}/tables/{table}", col, fixture.N_SHARDS)
            for table, col in DISTRIBUTION_COLUMN.items()}


def _drop_distributed(spark, root: str) -> None:
    for table in DISTRIBUTION_COLUMN:
        spark.sql(f"DROP TABLE IF EXISTS t_{root.rsplit('-', 1)[-1]}_{table}")


def _over_distributed(name: str, question):
    def query(spark, sf):
        root = scratch_dir(spark, name)
        try:
            return _kept(spark, root, question(_distributed(spark, sf, root)))
        finally:
            _drop_distributed(spark, root)
    return query


def product_activity_of(t: dict[str, DataFrame]) -> DataFrame:
    return product_activity(t["events_clean"], t["events_agg"])


def bucket_placement_of(t: dict[str, DataFrame]) -> DataFrame:
    parts = [bucket_placement(t[k], k, col, fixture.N_SHARDS) for k, col in DISTRIBUTION_COLUMN.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_reconcile_content(spark, sf):
    """Source rows against a copy with some rows altered: counts agree everywhere, the
    content does not; beside each batch how many rows differ."""
    cols = [*EVENT_COLUMNS, "batch_id"]
    before = _events(spark, sf)
    after = fixture.some_altered(before)
    report = reconcile_content(before, after, ["batch_id"], cols)
    rows = content_differences(before, after, report, ["batch_id"], cols)
    n = rows.groupBy("batch_id").agg(F.sum(F.abs("surplus")).cast("long").alias("differing_rows"))
    return report.join(n, "batch_id", "left").withColumn("differing_rows", F.coalesce("differing_rows", F.lit(0).cast("long")))


WEEK = 7


def _summaries(spark, sf, root: str):
    """(per-(batch, IP) counts, events with their wait, summaries), all stored."""
    t = _tables(spark, sf).settle(f"{root}/work/counts")
    with_wait(t.events.select("batch_id", "event_ts"), spans_of(t.counts, CFG)).write.parquet(f"{root}/work/waits")
    waits = spark.read.parquet(f"{root}/work/waits")
    batch_summaries(waits, t.counts).write.parquet(f"{root}/tables/summaries")
    return t.counts, waits, spark.read.parquet(f"{root}/tables/summaries")


def _over_summaries(name: str, question):
    def query(spark, sf):
        root = scratch_dir(spark, name)
        return _kept(spark, root, question(*_summaries(spark, sf, root)))
    return query


def _ranges():
    return F.floor(F.col("batch_id") / WEEK)


def distinct_ips_of(counts, waits, summaries) -> DataFrame:
    """Distinct IPs per week of batches and over all, exactly, and whether the united
    sketches come within 3 %."""
    exact, estimate = (f(x, _ranges()).unionByName(f(x, F.lit(-1).cast("long"))) for f, x in
                       ((distinct_exact, counts), (distinct_estimate, summaries)))
    near = F.abs(F.col("estimate") - F.col("distinct_ips")) <= F.col("distinct_ips") * 0.03 + 0.5
    return exact.join(estimate, "range").select("range", "distinct_ips", near.alias("estimate_near"))


def wait_quantiles_of(counts, waits, summaries) -> DataFrame:
    """Quantiles of the wait per week of batches, exactly, and whether the merged
    sketches' quantiles lie within a rank of 2 % of theirs."""
    exact, guess = quantiles_exact(waits, _ranges()), quantile_estimates(summaries, _ranges())
    guesses = guess.select("range", *[F.col(q).alias(f"g_{q}") for q in QUANTILES])
    ranked = waits.select(_ranges().alias("range"), "wait_ms").join(guesses, "range").groupBy("range").agg(*[
        (F.abs(F.avg((F.col("wait_ms") <= F.col(f"g_{name}")).cast("int")) - q) <= 0.02).alias(f"near_{name}") for name, q in QUANTILES.items()])
    return exact.join(ranked, "range")


def heavy_hitters_of(counts, waits, summaries) -> DataFrame:
    return heavy_hitters(counts, summaries)


SAMPLE_QUESTIONS = {
    "top_products": ("product_id", "action", "total", None, None), "throughput": ("batch_ts", None, "total_events", "legit_events", "flagged_events"),
    "flagged_pct": (None, None, "legit_total", "flagged_total", None), "top_offenders": ("ip_address", None, "flagged_event_count", "batches_flagged_in", None),
    "latency_distribution": (None, None, "min_ms", "max_ms", "batch_count"), "minute_rollup": ("minute", None, "events_in_minute", None, None),
    "table_counts": ("table_name", None, "row_count", None, None), "latest_batches": ("batch_ts", None, "batch_id", "total_events", "processing_time_ms")}


def stored_answers_of(spark, root: str) -> DataFrame:
    """The questions asked of the four tables, over the tables as stored and committed:
    a row per answer row, with its keys as text and its numbers."""
    tables = {t: read_table(spark, root, t) for t in TABLES}
    tables["events_agg"] = upsert_view(tables["events_agg"])
    metrics = tables["pipeline_metrics"]
    answers = {"top_products": A.top_products(tables["events_agg"]), "throughput": A.throughput(metrics), "flagged_pct": A.flagged_pct(metrics),
               "top_offenders": A.top_offenders(tables["events_flagged"]), "latency_distribution": A.latency_distribution(metrics),
               "minute_rollup": A.minute_rollup(metrics), "table_counts": A.table_counts(tables), "latest_batches": A.latest_batches(metrics)}
    out = None
    for name, cols in SAMPLE_QUESTIONS.items():
        kinds = ["string", "string", "long", "long", "long"]
        shown_ = [(F.col(c) if c else F.lit(None)).cast(k).alias(a) for c, k, a in zip(cols, kinds, ("k0", "k1", "n0", "n1", "n2"))]
        part = answers[name].select(F.lit(name).alias("question"), *shown_)
        out = part if out is None else out.unionByName(part)
    return out


def q_stored_answers(spark, sf):
    root = scratch_dir(spark, "answers")
    write_history(_tables(spark, sf), f"{root}/tables", f"{root}/work/history")
    return _kept(spark, root, stored_answers_of(spark, f"{root}/tables"))


def q_written_rows(spark, sf):
    """What the write jobs of each micro-batch observed that they wrote, beside the rows
    that the tables hold."""
    root = scratch_dir(spark, "written")
    events = _events(spark, sf).withColumn("run", F.floor(F.col("batch_id") / fixture.DEAD_LETTER_DAYS))
    _processed(spark, root, events, fixture.WRITTEN_CONFIG, report=True)
    return _kept(spark, root, reconcile_written(spark, f"{root}/tables"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "encode_messages": q_encode_messages,
    "parse_events": q_parse_events,
    "validate_events": q_validate_events,
    "batch_span": q_batch_span,
    "ip_rate": q_ip_rate,
    "flag_reason": q_flag_reason,
    "flagged_events": q_flagged_events,
    "clean_events": q_clean_events,
    "events_agg": q_events_agg,
    "upsert_events_agg": q_upsert_events_agg,
    "batch_metrics": q_batch_metrics,
    "conservation": _settled("conservation"),
    "micro_batch_split": q_micro_batch_split,
    "batch_pipeline": q_batch_pipeline,
    "top_products": q_top_products,
    "throughput": q_throughput,
    "flagged_pct": q_flagged_pct,
    "top_offenders": q_top_offenders,
    "latency_distribution": q_latency_distribution,
    "minute_rollup": q_minute_rollup,
    "table_counts": _settled("table_counts"),
    "latest_batches": q_latest_batches,
    "latency_series": q_latency_series,
    "flagged_ip_series": q_flagged_ip_series,
    "message_rate": q_message_rate,
    "shard_distribution": _settled("shard_distribution"),
    "reconcile_counts": _settled("reconcile_counts"),
    "detection_accuracy": q_detection_accuracy,
    "rate_conformance": q_rate_conformance,
    "action_mix": q_action_mix,
    "dead_letters": q_dead_letters,
    "window_verdicts": q_window_verdicts,
    "window_metrics": q_window_metrics,
    "window_detector": q_window_detector,
    "late_rows": q_late_rows,
    "trailing_rate": q_trailing_rate,
    "product_activity": _over_distributed("activity", product_activity_of),
    "bucket_placement": _over_distributed("placement", bucket_placement_of),
    "reconcile_content": q_reconcile_content,
    "distinct_ips": _over_summaries("distinct", distinct_ips_of),
    "wait_quantiles": _over_summaries("waits", wait_quantiles_of),
    "heavy_hitters": _over_summaries("heavy", heavy_hitters_of),
    "written_rows": q_written_rows,
    "stored_answers": q_stored_answers,
}
