"""The four output tables for a whole history of batches at once.

The same detection functions as a micro-batch, keyed on the ``batch_id``
column; used for backfills, for the analytical questions over derived data,
and to check streaming output against a batch run.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig
from surgeflow.operators.aggregate import events_agg, upsert_view
from surgeflow.operators.detect import batch_metrics, clean_of, flagged_of, ip_counts, rates_of, with_verdict
from surgeflow.schema import METRIC_COLUMNS
from surgeflow.sources.messages import validate_events
from surgeflow.sources.sinks import run_writes, write_batches
from surgeflow.sources.tables import TABLES, batch_path, delete_paths, live_batches, refuse_closed


class Tables:
    """The four tables (and intermediates) of a history of batches.

    Each member is built on first use, so a question that needs only the
    metrics never constructs the row-level split.
    """

    def __init__(self, events: DataFrame, cfg: DetectorConfig, stamps: DataFrame,
                 window_start: Column):
        self._raw, self._cfg, self._stamps, self._window_start = events, cfg, stamps, window_start

    @cached_property
    def _validated(self) -> tuple[DataFrame, DataFrame]:
        cols = ["event_id", "user_id", "action", "product_id", "ip_address", "event_ts"]
        return validate_events(self._raw.select(*cols, "batch_id"), required=cols)

    @property
    def events(self) -> DataFrame:
        """Valid events with batch_id."""
        return self._validated[0]

    @property
    def dead_letter(self) -> DataFrame:
        return self._validated[1]

    @cached_property
    def counts(self) -> DataFrame:
        """Per (batch, IP) events and their time bounds."""
        return ip_counts(self.events)

    @cached_property
    def rates(self) -> DataFrame:
        """Per (batch, IP) verdicts."""
        return rates_of(self.counts, self._cfg)

    def settle(self, path: str) -> Tables:
        """Write the counts to a work table: the rule reads the events once from here on."""
        self.counts.write.mode("overwrite").parquet(path)
        self.counts = self.events.sparkSession.read.schema(self.counts.schema).parquet(path)
        return self

    @cached_property
    def verdicts(self) -> DataFrame:
        """Valid events with the reason they are flagged for, if they are."""
        return with_verdict(self.events, self.rates)

    @property
    def clean(self) -> DataFrame:
        return clean_of(self.verdicts)

    @property
    def flagged(self) -> DataFrame:
        return flagged_of(self.verdicts)

    @cached_property
    def keyed(self) -> DataFrame:
        """Clean and flagged rows per aggregate key, from one pass."""
        return (self.verdicts.groupBy(self._window_start.alias("window_start"), "product_id", "action")
                .agg(F.count_if(F.col("reason").isNull()).alias("clean_rows"), F.count("reason").alias("flagged_rows")))

    @cached_property
    def agg_deltas(self) -> DataFrame:
        """Per batch (window_start, product, action) counts."""
        return events_agg(self.clean, self._window_start)

    @cached_property
    def agg(self) -> DataFrame:
        """The upserted view."""
        return upsert_view(self.agg_deltas.select("window_start", "product_id", "action", "event_count"))

    @cached_property
    def metrics(self) -> DataFrame:
        """pipeline_metrics without created_at."""
        stamps = self._stamps.select("batch_id", "batch_ts", "processing_time_ms")
        return batch_metrics(self.rates).join(stamps, "batch_id").select(*METRIC_COLUMNS)

    @property
    def window_start(self) -> Column:
        return self._window_start

    @property
    def stamps(self) -> DataFrame:
        return self._stamps

    def as_dict(self) -> dict[str, DataFrame]:
        return {"events_clean": self.clean, "events_flagged": self.flagged,
                "events_agg": self.agg, "pipeline_metrics": self.metrics}


def derive_tables(events: DataFrame, cfg: DetectorConfig, stamps: DataFrame,
                  window_start: Column) -> Tables:
    """``events``: parsed events with ``batch_id``. ``stamps``: per batch
    (batch_id, batch_ts, processing_time_ms). ``window_start``: the stamp of
    each row's aggregate key."""
    return Tables(events, cfg, stamps, window_start)


def write_history(tables: Tables, root: str, work_root: str) -> None:
    """Backfill the four tables for every batch in ``tables``, replay-safe.

    The per-(batch, IP) counts and rates, and the events with their verdicts, are written
    once to ``work_root`` (tables in the shared folder: they cut the lineage and
    survive executor loss); every output reads them. A batch in a closed range
    is refused. Commit marks of all batches go first, then what an earlier run
    stored of them in any table, so that a batch that now has no rows in a table
    keeps none; the metrics rows are written last: each batch becomes visible
    only when all of its tables are in place. Events that lack a field go to the dead
    letter, those without a time with the first batch. Only batch ids reach the driver,
    one number a batch, as many as there are directories to replace.
    """
    spark = tables.events.sparkSession
    work = work_root.rstrip("/")
    tables.settle(f"{work}/counts").rates.write.mode("overwrite").parquet(f"{work}/rates")
    rates = spark.read.parquet(f"{work}/rates")
    with_verdict(tables.events, rates).write.mode("overwrite").parquet(f"{work}/verdicts")
    verdicts = spark.read.parquet(f"{work}/verdicts")
    ids = rates.select("batch_id").unionByName(tables.stamps.select("batch_id")).where("batch_id IS NOT NULL").distinct()
    batches = {r["batch_id"] for r in ids.toLocalIterator()}
    refuse_closed(spark, root, sorted(batches))
    for table in [*reversed(TABLES), "dead_letter"]:  # the marks first
        delete_paths(spark, [batch_path(root, table, b) for b in batches.intersection(live_batches(spark, root, table))])
    clean = clean_of(verdicts)
    # an event without a time names no batch: it is set aside with the first
    dead = tables.dead_letter.withColumn("batch_id", F.coalesce("batch_id", F.lit(min(batches, default=0)).cast("long")))
    run_writes([lambda: write_batches(dead.withColumn("raw", F.lit(None).cast("string")), root, "dead_letter"),
                lambda: write_batches(clean, root, "events_clean", sort_by=["event_ts"]),
                lambda: write_batches(flagged_of(verdicts), root, "events_flagged", sort_by=["event_ts"]),
                lambda: write_batches(events_agg(clean, tables.window_start), root, "events_agg")])
    stamps = tables.stamps.select("batch_id", "batch_ts", "processing_time_ms")
    metrics = batch_metrics(rates).join(stamps, "batch_id").select(*METRIC_COLUMNS)
    write_batches(metrics, root, "pipeline_metrics")
