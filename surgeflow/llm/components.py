"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace


def apart(small: DataFrame) -> DataFrame:
    """The aggregated side of a join, dealt anew: the other side's rows then come by
    an exchange of their own, of which a hot key's partition is split (AQE skew
    join), and nothing is broadcast."""
    return small.hint("rebalance").hint("shuffle_hash")


def connected_components(links: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node
    of ``links`` (long columns ``a`` and ``b``; loops and repeats allowed).

    Large-star and small-star rounds: every node points its larger neighbours,
    then its smaller ones and itself, to the smallest node it knows, until
    nothing changes; the number of rounds grows with the logarithm of the
    longest chain. Minima are aggregated map-side and joined back by a join that
    splits hot nodes; nothing passes through the driver. Each round is written to the shared
    folder, which also cuts its lineage.
    """
    edges = ws.write(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct(), f"{name}-0")
    seen, i = None, 0
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(apart(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(apart(least), "u")
        small = (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        i += 1
        edges = ws.write(small, f"{name}-{i}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    stars = edges.groupBy("u").agg(F.min("v").alias("root"))
    roots = stars.select(F.col("root").alias("node"), "root").distinct()
    return stars.select(F.col("u").alias("node"), "root").unionByName(roots)
