"""Evaluation: detection accuracy, rate conformance, action mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.functions.columns import ntz

# The generator's action weights per traffic class.
ACTION_WEIGHTS = {
    "normal": {"VIEW": 0.70, "ADD_TO_CART": 0.20, "PURCHASE": 0.10},
    "bot": {"VIEW": 0.10, "ADD_TO_CART": 0.20, "PURCHASE": 0.70},
}


def _ratio(num, den, digits: int = 4):
    return F.round(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def detection_accuracy(events: DataFrame, rates: DataFrame, label: str = "is_bot_label") -> DataFrame:
    """Event-level confusion counts of the rule against a known-bot label,
    with precision, recall and false-positive rate.

    Events are first reduced to (batch, IP, label) counts, so the join with the
    per-(batch, IP) verdicts is over pre-aggregated rows; both sides arrive
    hash-partitioned on (batch_id, ip_address).
    """
    labelled = (events.groupBy("batch_id", "ip_address", F.col(label).alias("label"))
                .agg(F.count(F.lit(1)).alias("m")))
    j = labelled.join(rates.select("batch_id", "ip_address", "is_bot"), ["batch_id", "ip_address"])

    def cnt(cond):
        return F.sum(F.when(cond, F.col("m")).otherwise(F.lit(0))).cast("long")

    lab, flag = F.col("label"), F.col("is_bot")
    out = j.agg(cnt(flag & lab).alias("tp"), cnt(flag & ~lab).alias("fp"),
                cnt(~flag & lab).alias("fn"), cnt(~flag & ~lab).alias("tn"))
    return out.select(
        "tp", "fp", "fn", "tn",
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fp_rate"))


def phase_counts(events: DataFrame, phases: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Events per phase: (phase_id, start_ts, eps, actual, duration_sec).

    ``phases``: (phase_id, start_ts, end_ts, eps), half-open and to the microsecond;
    best a stored table, as it is read three times. Events are matched by an equi
    join on a time bucket: buckets that lie within a phase are counted as a whole,
    and only the events of a phase's edge buckets are compared with its bounds. The
    events are read twice, once for either.
    """
    width = F.lit(int(bucket_seconds) * 1_000_000)
    at = events.select(F.unix_micros("event_ts").alias("us")).withColumn("bucket", F.floor(F.col("us") / width))
    ph = (phases.withColumn("start_us", F.unix_micros("start_ts"))
          .withColumn("end_us", F.unix_micros("end_ts")))
    parts = ph.filter("end_us > start_us").select("phase_id", "start_us", "end_us", F.explode(F.sequence(
        F.floor(F.col("start_us") / width), F.floor((F.col("end_us") - F.lit(1)) / width))).alias("bucket"))
    whole = (F.col("bucket") * width >= F.col("start_us")) & ((F.col("bucket") + 1) * width <= F.col("end_us"))
    full = (at.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
            .join(parts.filter(whole).select("bucket", "phase_id"), "bucket").select("phase_id", "n"))
    edge = (at.join(parts.filter(~whole), "bucket").filter("us >= start_us AND us < end_us")
            .groupBy("phase_id").agg(F.count(F.lit(1)).alias("n")))
    hits = full.unionByName(edge).groupBy("phase_id").agg(F.sum("n").cast("long").alias("actual"))
    return (ph.join(hits, "phase_id", "left")
            .select("phase_id", "start_ts", "eps", F.coalesce("actual", F.lit(0).cast("long")).alias("actual"),
                    ((F.col("end_us") - F.col("start_us")) / F.lit(1e6)).alias("duration_sec")))


def conformance_of(counts: DataFrame, tol: float = 0.01) -> DataFrame:
    """Achieved events against ``eps x duration`` from ``phase_counts``.

    A NULL eps means a uniform target, total events over total phase time, for which
    the counts are read a second time: best a stored table. A phase that expects
    nothing has an error of 0.
    """
    uniform = counts.agg(F.sum("actual") / F.nullif(F.sum("duration_sec"), F.lit(0.0))).scalar()
    expected = F.coalesce(F.col("eps").cast("double"), uniform, F.lit(0.0)) * F.col("duration_sec")
    off = F.abs(F.col("actual") - F.col("expected")) / F.nullif(F.col("expected"), F.lit(0.0))
    return (counts.withColumn("expected", expected)
            .withColumn("rel_error", F.coalesce(off, F.lit(0.0)))
            .select("phase_id", ntz("start_ts").alias("start_ts"), "expected", "actual", "rel_error",
                    (F.col("rel_error") <= F.lit(tol)).alias("within_tol")))


def rate_conformance(events: DataFrame, phases: DataFrame, tol: float = 0.01,
                     bucket_seconds: int = 3600) -> DataFrame:
    """``conformance_of`` the ``phase_counts``, in one lazy plan."""
    return conformance_of(phase_counts(events, phases, bucket_seconds), tol)


def action_mix(events: DataFrame, class_col: str = "traffic_class") -> DataFrame:
    """Share of each action within each traffic class, with the expected weight.

    The per-class total is a window over the (class x action) aggregate, a
    handful of rows, never over events.
    """
    counts = (events.groupBy(F.col(class_col).alias("traffic_class"), "action")
              .agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy("traffic_class"))
    expected = None
    for cls, weights in ACTION_WEIGHTS.items():
        for act, w in weights.items():
            cond = (F.col("traffic_class") == F.lit(cls)) & (F.upper("action") == F.lit(act))
            expected = F.when(cond, F.lit(w)) if expected is None else expected.when(cond, F.lit(w))
    return counts.select("traffic_class", "action", "n",
                         F.round(F.col("n") / total, 4).alias("share"),
                         expected.alias("expected_share"))
