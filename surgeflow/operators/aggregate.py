"""Per-batch (product, action) counts of clean rows and the additive upsert view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.functions.columns import reusable
from surgeflow.schema import AGG_KEY


def events_agg(clean: DataFrame, window_start: Column) -> DataFrame:
    """Clean rows counted per (batch_id, window_start, product_id, action).

    ``window_start`` is a column: the batch's stamp (a literal in a
    micro-batch) or an event-time bucket such as ``date_trunc('minute', ...)``.
    Partial counts are combined map-side, so a hot product costs nothing extra.
    """
    return (clean.groupBy("batch_id", window_start.alias("window_start"), "product_id", "action")
            .agg(_event_count()))


@reusable
def _event_count() -> Column:
    return F.count(F.lit(1)).alias("event_count")


def upsert_view(deltas: DataFrame) -> DataFrame:
    """Additive upsert read side: a new key inserts, a repeated key adds its
    ``event_count``. Deltas are stored per batch, so a replay replaces its
    own delta instead of adding twice."""
    return (deltas.groupBy(*AGG_KEY)
            .agg(F.sum("event_count").cast("long").alias("event_count")))
