"""The per-micro-batch split and its replay-safe write protocol.

``BatchProcessor`` is the ``foreachBatch`` function. Per non-empty batch:

1. persist the batch (MEMORY_AND_DISK) and run ONE aggregate over it that
   yields the raw and dead-letter counts;
2. clear this batch's metrics row (the commit mark) before touching data;
3. write dead letters, clean rows, flagged rows and the aggregate delta, each
   replacing its own ``batch_id=<id>`` directory (independent writes, run as
   concurrent Spark jobs);
4. compute the metrics row from the per-IP verdicts and write it last.

A replay therefore rewrites the same directories, and a batch cut off
between writes stays invisible to readers until its metrics row exists. An
empty batch writes nothing and clears what an earlier run of the same id
wrote. A batch id inside a compacted (closed) range is refused. Nothing but
one counts row is brought to the driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from surgeflow.config import DetectorConfig, WallClock
from surgeflow.functions.columns import instant, reusable
from surgeflow.operators.aggregate import events_agg
from surgeflow.operators.detect import batch_metrics, ip_rate, split_events
from surgeflow.schema import EVENT_COLUMNS, METRIC_COLUMNS
from surgeflow.sources.messages import validation_error
from surgeflow.sources.sinks import (clear_batch, run_writes, write_agg_delta,
                                     write_batch_metrics, write_partition, write_report)
from surgeflow.sources.tables import refuse_closed

DATA_TABLES = ["dead_letter", "events_clean", "events_flagged", "events_agg"]


@reusable
def _count_aggs():
    return F.count(F.lit(1)).alias("n_raw"), F.count("error").alias("n_dead")


class BatchProcessor:
    """Callable ``(batch_df, batch_id)`` for ``writeStream.foreachBatch``.

    ``clock`` supplies the batch stamp and elapsed time (wall clock by
    default, fixed in tests). ``agg_window`` keys the aggregate deltas by an
    event-time bucket instead of the batch stamp. ``parallel_writes`` runs the independent table writes as concurrent jobs.
    ``report`` keeps what the write jobs observed of the rows they wrote
    (``write_report``). ``fail_after`` names a table after whose write an exception is raised:
    fault injection for replay tests.
    """

    def __init__(self, cfg: DetectorConfig, sink_root: str, clock=None,
                 fail_after: str | None = None, log=None,
                 parallel_writes: bool = True,
                 agg_window: str | None = None, report: bool = False):
        self.cfg = cfg
        self.report = report
        self.agg_window = agg_window
        self.parallel_writes = parallel_writes
        self.root = sink_root
        self.clock = clock or WallClock()
        self.fail_after = fail_after
        self.log = log
        self.last_metrics = None

    def _maybe_fail(self, table: str) -> None:
        if self.fail_after == table:
            raise RuntimeError(f"injected failure after writing {table}")

    def _write_dead(self, checked: DataFrame, spark, bid: int, n_dead: int) -> None:
        if not n_dead:
            clear_batch(spark, self.root, "dead_letter", bid)
            return
        dead = checked.filter("error IS NOT NULL")
        if "raw" not in dead.columns:
            dead = dead.withColumn("raw", F.lit(None).cast("string"))
        (dead.select(*EVENT_COLUMNS, "raw", "error").write.mode("overwrite")
         .parquet(f"{self.root}/dead_letter/batch_id={bid}"))

    def _run(self, writes) -> None:
        """The independent table writes of a batch (see ``run_writes``); the
        metrics mark is written only after all of them succeed."""
        def one(table, fn):
            def go():
                fn()
                self._maybe_fail(table)
            return go
        run_writes([one(t, fn) for t, fn in writes], parallel=self.parallel_writes)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        start = self.clock.monotonic()
        stamp = self.clock.now()
        bid = int(batch_id)
        refuse_closed(spark, self.root, [bid])
        # The raw message text is kept only on rows that fail validation (for
        # the dead letter), so the persisted batch holds parsed fields only.
        raw = ([F.when(validation_error().isNotNull(), F.col("raw")).alias("raw")]
               if "raw" in batch_df.columns else [])
        checked = (batch_df.select(*EVENT_COLUMNS, *raw, validation_error().alias("error"))
                   .persist(StorageLevel.MEMORY_AND_DISK))
        rates = None
        try:
            counts = checked.agg(*_count_aggs()).first()
            n_raw, n_dead = int(counts["n_raw"]), int(counts["n_dead"])
            clear_batch(spark, self.root, "pipeline_metrics", bid)
            if n_raw == 0:
                for t in DATA_TABLES:
                    clear_batch(spark, self.root, t, bid)
                self.last_metrics = None
                return

            writes = [("dead_letter", lambda: self._write_dead(checked, spark, bid, n_dead))]
            if n_raw == n_dead:
                for t in DATA_TABLES[1:]:
                    clear_batch(spark, self.root, t, bid)
                self._run(writes)
                self.last_metrics = None
                return

            events = (checked.filter("error IS NULL").select(*EVENT_COLUMNS)
                      .withColumn("batch_id", F.lit(bid).cast("long")))
            rates = ip_rate(events, self.cfg).persist(StorageLevel.MEMORY_AND_DISK)
            clean, flagged = split_events(events, rates)
            # Aggregate key: the batch stamp (as the original job), or an
            # event-time bucket ("minute", "hour", ...) that a replay reproduces.
            window_start = (F.date_trunc(self.agg_window, "event_ts") if self.agg_window
                            else instant(stamp))
            seen = {t: Observation(f"{t}-{bid}") if self.report else None for t in ("events_clean", "events_flagged")}
            writes += [
                ("events_clean",
                 lambda: write_partition(clean, self.root, "events_clean", bid, ["event_ts"], seen["events_clean"])),
                ("events_flagged",
                 lambda: write_partition(flagged, self.root, "events_flagged", bid, ["event_ts"], seen["events_flagged"])),
                ("events_agg",
                 lambda: write_agg_delta(events_agg(clean, window_start), self.root, bid)),
            ]
            self._run(writes)
            if self.report:
                write_report(spark, self.root, bid, {t: o.get for t, o in seen.items()})

            elapsed_ms = int(round((self.clock.monotonic() - start) * 1000))
            metrics = (batch_metrics(rates)
                       .withColumn("batch_ts", instant(stamp))
                       .withColumn("processing_time_ms", F.lit(elapsed_ms).cast("long"))
                       .select(*METRIC_COLUMNS))
            write_batch_metrics(metrics, self.root, bid)
            self.last_metrics = {"batch_id": bid, "raw": n_raw, "dead": n_dead,
                                 "processing_time_ms": elapsed_ms}
            if self.log:
                self.log(f"wrote batch {bid}: {n_raw - n_dead} valid rows, {n_dead} dead letters, {elapsed_ms} ms")
        finally:
            if rates is not None:
                rates.unpersist()
            checked.unpersist()


def process_batch(batch_df: DataFrame, batch_id: int, cfg: DetectorConfig, sink_root: str,
                  clock=None) -> None:
    BatchProcessor(cfg, sink_root, clock)(batch_df, batch_id)
