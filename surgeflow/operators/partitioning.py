"""Distribution of tables over shards and nodes, and reconciliation by count and content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.functions.columns import key_number


def distribute(df: DataFrame, n: int, col: str) -> DataFrame:
    """Hash-distribute rows by their distribution column (one shuffle)."""
    return df.repartition(n, F.col(col))


def hash_distribution(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows per hash bucket of ``col``; the bucket equals the partition that
    ``repartition(n, col)`` sends the row to. A skew report."""
    return (df.groupBy(F.pmod(F.hash(F.col(col)), F.lit(n)).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("rows")))


def write_distributed(df: DataFrame, table: str, path: str, col: str, n_buckets: int) -> DataFrame:
    """Store a table in ``n_buckets`` hash buckets of its distribution column.

    The one exchange is here: joins and aggregates on that column over tables of as
    many buckets need none. A partition of the rebalancing is a bucket; one that a
    hot key makes large is split over tasks, which each add a file to the bucket.
    """
    (df.hint("rebalance", n_buckets, F.col(col)).write.mode("overwrite").option("path", path)
     .bucketBy(n_buckets, col).sortBy(col).saveAsTable(table))
    return df.sparkSession.table(table)


def stored_buckets(stored: DataFrame) -> DataFrame:
    """Rows of a ``write_distributed`` table with the ``bucket`` of the file that holds them."""
    return stored.withColumn("bucket", F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\.c\d+)?[^_]*$", 1).cast("int"))


def bucket_rows(stored: DataFrame, name: str) -> DataFrame:
    """(table_name, shard, rows) as stored: ``shard_rows`` of the real buckets."""
    return (stored_buckets(stored).groupBy(F.col("bucket").cast("long").alias("shard")).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(name).alias("table_name"), "shard", "rows"))


def bucket_placement(stored: DataFrame, name: str, col: str, n_buckets: int) -> DataFrame:
    """(table_name, row_count, misplaced_rows): rows that lie in another bucket than their key's."""
    right = F.pmod(F.hash(F.col(col)), F.lit(n_buckets))
    return stored_buckets(stored).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("bucket") != right).alias("misplaced_rows")).select(
        F.lit(name).alias("table_name"), "row_count", "misplaced_rows")


def product_activity(clean: DataFrame, agg: DataFrame) -> DataFrame:
    """Per product its clean rows and last event beside what the aggregate table says
    of it; over tables distributed by ``product_id`` no row is exchanged."""
    rows = clean.groupBy("product_id").agg(F.count(F.lit(1)).alias("clean_rows"), F.max("event_ts").alias("last_event"))
    sums = agg.groupBy("product_id").agg(F.sum("event_count").cast("long").alias("agg_events"), F.count(F.lit(1)).alias("agg_keys"))
    return (rows.join(sums, "product_id", "full_outer")
            .select("product_id", "clean_rows", F.col("last_event").cast("timestamp_ntz").alias("last_event"), "agg_events", "agg_keys",
                    F.col("clean_rows").eqNullSafe(F.col("agg_events")).alias("balanced")))


def shard_of(col: str, n_shards: int):
    """Shard number of a key, any text: a portable hash modulo the shard count."""
    return F.pmod(key_number(col), F.lit(n_shards))


def placement(spark: SparkSession, n_shards: int, n_nodes: int) -> DataFrame:
    """Shard -> node (round robin); ``n_shards`` rows, built by Spark."""
    return spark.range(n_shards).select(
        F.col("id").alias("shard"),
        F.concat(F.lit("node_"), F.pmod(F.col("id"), F.lit(n_nodes)).cast("string")).alias("nodename"))


def shard_rows(df: DataFrame, name: str, col: str, n_shards: int, rows=None) -> DataFrame:
    """(table_name, shard, rows) of one table; ``rows``: a column that weighs its rows."""
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return (df.groupBy(shard_of(col, n_shards).alias("shard")).agg(n.cast("long").alias("rows"))
            .where("rows > 0").select(F.lit(name).alias("table_name"), "shard", "rows"))


def shard_distribution(parts: list[DataFrame], place: DataFrame) -> DataFrame:
    """(table_name, nodename, shard_count, row_count) from every table's
    ``shard_rows``: each is reduced to a row per shard before the join."""
    per_shard = parts[0]
    for part in parts[1:]:
        per_shard = per_shard.unionByName(part)
    return (per_shard.join(place, "shard")
            .groupBy("table_name", "nodename")
            .agg(F.count(F.lit(1)).alias("shard_count"), F.sum("rows").cast("long").alias("row_count")))


def reconcile_counts(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key before and after, full outer join, ``diff = after - before``.

    Both sides are aggregated first, so the join is over keys, not rows.
    """
    b = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("before_rows"))
    a = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("after_rows"))
    zero = F.lit(0).cast("long")
    return (b.join(a, keys, "full_outer")
            .withColumn("before_rows", F.coalesce("before_rows", zero))
            .withColumn("after_rows", F.coalesce("after_rows", zero))
            .withColumn("diff", F.col("after_rows") - F.col("before_rows")))


def _checksums(df: DataFrame, keys: list[str], cols: list[str], side: str) -> DataFrame:
    """Per key its rows and two sums of row hashes, which no order of rows changes. A
    column's null flag is hashed beside it: the hash itself passes nulls over."""
    marked = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *marked).cast("decimal(20,0)")).alias(f"{side}_{seed}") for seed in (1, 2)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{side}_rows"), *sums)


def reconcile_content(before: DataFrame, after: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``reconcile_counts`` that sees changed rows too: ``same`` where a key's rows are
    the same multiset before and after (by 128 bits of checksum). Both sides are
    reduced to a row per key, map-side first, before they meet."""
    both = _checksums(before, keys, cols, "before").join(_checksums(after, keys, cols, "after"), keys, "full_outer")
    zero = F.lit(0).cast("long")
    same = (F.col("before_rows").eqNullSafe(F.col("after_rows")) & F.col("before_1").eqNullSafe(F.col("after_1"))
            & F.col("before_2").eqNullSafe(F.col("after_2")))
    return both.select(*keys, F.coalesce("before_rows", zero).alias("before_rows"), F.coalesce("after_rows", zero).alias("after_rows"),
                       same.alias("same"))


def content_differences(before: DataFrame, after: DataFrame, report: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The rows of the keys that ``report`` (of ``reconcile_content``) finds changed,
    with ``surplus``: how many more there are after (negative: before). Rows of keys
    that agree are not compared one by one."""
    off = report.where("NOT same").select(*keys)
    sides = [df.select(*cols, F.lit(n).alias("surplus")).join(off, keys, "left_semi") for df, n in ((before, -1), (after, 1))]
    return (sides[0].unionByName(sides[1]).groupBy(*cols).agg(F.sum("surplus").cast("long").alias("surplus")).where("surplus <> 0"))
