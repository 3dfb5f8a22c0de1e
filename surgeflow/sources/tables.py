"""Table storage on a shared file system: one directory per batch.

Layout: ``<root>/<table>/batch_id=<id>/part-*.parquet``. A batch's directory
is replaced as a whole, which makes writes idempotent under replay.
``pipeline_metrics`` is written last and serves as the commit mark: readers
keep only batches that have a metrics row.

Closed ranges of batches are compacted into
``<root>/<table>_compacted/upto=<id>/`` (``batch_id`` as a data column); a
reader takes every compacted range plus the live batches above the highest
compacted id, so a range is never counted twice while its live directories
are being removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.operators.aggregate import upsert_view
from surgeflow.schema import AGG_KEY, TABLE_SCHEMAS

TABLES = ["events_clean", "events_flagged", "events_agg", "pipeline_metrics"]


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


DELETES = 16  # folders deleted at once


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete many folders, several at once: each is a call to the store, not a Spark job.
    All are gone on return."""
    with ThreadPoolExecutor(DELETES) as pool:
        list(pool.map(lambda p: delete_path(spark, p), paths))


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def batch_path(root: str, table: str, batch_id: int) -> str:
    return f"{table_path(root, table)}/batch_id={int(batch_id)}"


COMPACTED = "_compacted"


def compacted_path(root: str, table: str) -> str:
    return f"{table_path(root, table)}{COMPACTED}"


def _children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def compacted_ranges(spark: SparkSession, root: str, table: str) -> list[int]:
    """Upper batch ids of the compacted ranges of a table (directory names;
    one per compaction run, so a short list)."""
    names = _children(spark, compacted_path(root, table), "upto=")
    return sorted(int(n.split("=", 1)[1]) for n in names)


def _live(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    path = table_path(root, table)
    if not _children(spark, path, "batch_id="):
        return None
    return spark.read.schema(TABLE_SCHEMAS[table]).option("basePath", path).parquet(path)


def _parts(spark: SparkSession, root: str, table: str):
    """(compacted rows or None, live rows above the compacted range or None)."""
    schema = TABLE_SCHEMAS[table]
    uptos = compacted_ranges(spark, root, table)
    live = _live(spark, root, table)
    if not uptos:
        return None, live
    cp = compacted_path(root, table)
    comp = spark.read.schema(schema).parquet(*[f"{cp}/upto={u}" for u in uptos])
    if live is not None:
        live = live.filter(F.col("batch_id") > F.lit(max(uptos)))
    return comp.select(*schema.fieldNames()), live


def read_raw_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All batches of a table, committed or not, with a typed ``batch_id``."""
    comp, live = _parts(spark, root, table)
    frames = [f for f in (comp, live) if f is not None]
    if not frames:
        return spark.createDataFrame([], TABLE_SCHEMAS[table])
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(*TABLE_SCHEMAS[table].fieldNames())


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batch ids that have a metrics row. Every metrics row has events (an
    empty batch writes none), and stating that predicate lets Catalyst treat
    this side as selective and prune the data table's batch directories
    dynamically instead of reading them and dropping the rows."""
    return (read_raw_table(spark, root, "pipeline_metrics")
            .filter(F.col("total_events") > 0).select("batch_id"))


def read_table(spark: SparkSession, root: str, table: str, committed_only: bool = True) -> DataFrame:
    """A stored table for analysis. With ``committed_only`` rows of live
    batches without a metrics row (a batch cut off between its writes) are
    hidden; the semi join on the partition column lets dynamic partition
    pruning skip their directories. Compacted ranges hold committed rows only."""
    if not committed_only or table in ("pipeline_metrics", "dead_letter"):
        return read_raw_table(spark, root, table)
    comp, live = _parts(spark, root, table)
    if live is not None:
        live = live.join(committed_batches(spark, root), "batch_id", "left_semi")
    frames = [f for f in (comp, live) if f is not None]
    if not frames:
        return spark.createDataFrame([], TABLE_SCHEMAS[table])
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(*TABLE_SCHEMAS[table].fieldNames())


def compact(spark: SparkSession, root: str, table: str, upto: int) -> bool:
    """Rewrite the committed live batches ``<= upto`` of a table into one
    compacted range; only for closed batches that will not be replayed.

    The range is written under a temporary name, renamed into place, and only
    then are its live directories removed; a reader in between sees the
    compacted copy and ignores the live one. Aggregate deltas are summed per
    key on the way (the upsert view's result is unchanged); other tables keep
    their rows, sorted by batch. One compaction of a table runs at a time: what
    a cut-off one wrote before the rename is deleted. Returns whether anything
    was compacted.
    """
    cp = compacted_path(root, table)
    delete_paths(spark, [f"{cp}/{n}" for n in _children(spark, cp, "_tmp-")])
    done = compacted_ranges(spark, root, table)
    lo = max(done) if done else None
    if lo is not None and upto <= lo:
        _drop_copied(spark, root, table, lo)  # left over where an earlier run was cut off
        return False
    copied = [b for b in live_batches(spark, root, table) if b <= upto]
    rows = read_table(spark, root, table, committed_only=True)
    rows = rows.filter(F.col("batch_id") <= F.lit(int(upto)))
    if lo is not None:
        rows = rows.filter(F.col("batch_id") > F.lit(lo))
    if table == "events_agg":
        rows = (rows.groupBy(*AGG_KEY).agg(F.sum("event_count").cast("long").alias("event_count"))
                .withColumn("batch_id", F.lit(int(upto)).cast("long")))
    rows = rows.select(*TABLE_SCHEMAS[table].fieldNames())
    tmp = f"{cp}/_tmp-{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance").sortWithinPartitions("batch_id").write.mode("overwrite").parquet(tmp)
    fs, src = _fs_path(spark, tmp)
    _, dst = _fs_path(spark, f"{cp}/upto={int(upto)}")
    if not fs.rename(src, dst):
        raise RuntimeError(f"could not move compacted range into {cp}/upto={upto}")
    delete_paths(spark, [batch_path(root, table, b) for b in copied])
    return True


def _drop_copied(spark: SparkSession, root: str, table: str, upto: int) -> None:
    """Live directories of batches that the compacted range already holds."""
    delete_paths(spark, [batch_path(root, table, b) for b in live_batches(spark, root, table) if b <= upto])


def register_views(spark: SparkSession, root: str, committed_only: bool = True) -> None:
    """Temp views named like the tables, for ``spark.sql`` users."""
    for t in TABLES:
        df = read_table(spark, root, t, committed_only)
        if t == "events_agg":
            df = upsert_view(df)
        df.createOrReplaceTempView(t)


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A table of a JDBC store (the original sink) for analysis. With a
    numeric ``partition_column`` and bounds, Spark reads it in parallel
    ranges instead of one connection."""
    reader = spark.read
    if partition_column and num_partitions:
        return reader.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=properties)
    return reader.jdbc(url, table, properties=properties)


CLOSED = "_closed"


def closed_upto(spark: SparkSession, root: str) -> int | None:
    """The highest batch id that has been closed for compaction."""
    names = _children(spark, f"{root.rstrip('/')}/{CLOSED}", "upto=")
    found = [int(n.split("=", 1)[1]) for n in names]
    for t in TABLES:
        found += compacted_ranges(spark, root, t)
    return max(found, default=None)


def refuse_closed(spark: SparkSession, root: str, batch_ids: list[int]) -> None:
    """Raise if a batch to be written lies in a closed range."""
    closed = closed_upto(spark, root)
    inside = [b for b in batch_ids if closed is not None and b <= closed]
    if inside:
        raise ValueError(f"batch {min(inside)} lies in a compacted (closed) range up to {closed}; "
                         "only batches above it can be written or replayed")


def live_batches(spark: SparkSession, root: str, table: str) -> list[int]:
    """Batch ids that have a directory of their own (names only, no data)."""
    return sorted(int(n.split("=", 1)[1]) for n in _children(spark, table_path(root, table), "batch_id="))


def compact_closed(spark: SparkSession, root: str, upto: int) -> dict[str, bool]:
    """Close the batches up to ``upto`` and compact every table's.

    Refused unless ``upto`` is at most the highest committed batch and no batch
    at or below it holds data without a commit mark. The closing is published
    first, so that from then on no writer touches the range; a run that is cut
    off is finished by calling again. Data tables go first, the commit marks
    (metrics) last.
    """
    upto, closed = int(upto), closed_upto(spark, root)
    if closed is None or upto > closed:
        marks = set(live_batches(spark, root, "pipeline_metrics"))
        if not marks or upto > max(marks):
            raise ValueError(f"batch {upto} is above the highest committed batch {max(marks, default=None)}")
        cut_off = sorted({b for t in TABLES for b in live_batches(spark, root, t) if b <= upto} - marks)
        if cut_off:
            raise ValueError(f"batch {cut_off[0]} was cut off before its commit mark; replay it before closing {upto}")
        fs, p = _fs_path(spark, f"{root.rstrip('/')}/{CLOSED}/upto={upto}")
        fs.mkdirs(p)
    order = ["dead_letter", "events_clean", "events_flagged", "events_agg", "pipeline_metrics"]
    return {t: compact(spark, root, t, upto) for t in order}
