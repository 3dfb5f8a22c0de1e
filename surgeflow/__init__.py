"""surgeflow: Spark-native clickstream bot separation and analytics.

Micro-batches of click events are split into clean and flagged traffic by an
event rate normalised to each batch's own event-time span; four tables
(events_clean, events_flagged, events_agg, pipeline_metrics) are kept
replay-safe on Parquet, and the analytical questions are DataFrame plans over
those tables.
"""

from surgeflow.config import DetectorConfig, FixedClock, WallClock

__all__ = ["DetectorConfig", "FixedClock", "WallClock"]
