"""Sharding by Hilbert-curve order.

Several metadata dimensions (text size on a log scale, language, source) are
quantised to ``BITS`` bits each; the documents are sorted by the index of their
cell on the Hilbert curve, ties by id and checksum, and the order is cut into
runs whose counts differ by one at most. Rows of a run are neighbours in every
dimension, so that a shard's files carry narrow min/max ranges for pruning.

Only narrow rows (id, size, checksum, dimensions) are sorted, by a range
exchange on the whole order key: however many documents share a cell, they
spread over partitions. Categories are numbered through their distinct values.
Null texts have no bytes, null categories a number of their own, null ids come
first in a cell; repeated rows take a slot each. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, global_rank, whole_text

BITS = 8


def curve_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (rows x dimensions)."""
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the curve's rotations from the coarsest level down
        p = q - 1
        for i in range(n):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & p)
            flip = np.where(x[i] & q, p, 0)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ flip ^ (swap if i else 0)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros_like(t)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] ^ t) >> level & 1
    return out


def _category(df: DataFrame, col: str, name: str, bits: int) -> DataFrame:
    """``name``: the place of ``col``'s value among the distinct values, in ``bits`` bits."""
    values = df.select(F.col(col).alias("_v")).distinct()
    order = Window.orderBy(F.col("_v").isNull(), "_v")  # a row per distinct value
    values = values.select("_v", F.row_number().over(order).alias("_n"))
    last = values.agg(F.max("_n")).first()[0] or 1
    step = F.expr(f"(_n - 1) * {1 << bits} div {last}")
    values = values.select("_v", step.cast("int").alias(name))
    return df.join(values, F.col(col).eqNullSafe(F.col("_v")), "left").drop("_v")


def hilbert_order(docs: DataFrame, ws: Workspace, bits: int = BITS, id_col: str = "doc_id",
                  text_col: str = "text", categories: tuple = ("lang", "source")) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``cell`` (curve index) and ``rank`` per document,
    and its categories as ``_c0``, ``_c1`` and so on."""
    text = whole_text(text_col).cast("binary")
    meta = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       *[F.col(c).alias(f"_c{i}") for i, c in enumerate(categories)])
    meta = ws.write(meta, "meta")
    top = meta.agg(F.max(F.log2(F.col("size").cast("double")))).first()[0] or 1.0
    scaled = F.floor(F.log2(F.col("size").cast("double")) / F.lit(max(top, 1.0)) * ((1 << bits) - 1))
    dims = meta.withColumn("_d", scaled.cast("int"))
    for i in range(len(categories)):
        dims = _category(dims, f"_c{i}", f"_d{i}", bits)
    names = ["_d", *[f"_d{i}" for i in range(len(categories))]]

    @F.pandas_udf("long")
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(curve_index(b.to_numpy(), bits))

    labels = [f"_c{i}" for i in range(len(categories))]
    cells = dims.select("doc_id", "size", "text_crc32", *labels, index(F.struct(*names)).alias("cell"))
    return global_rank(cells, [F.col("cell"), F.col("doc_id"), F.col("text_crc32")])


def cut_runs(ranked: DataFrame, shards: int) -> DataFrame:
    """``shard`` (runs of the order, counts at most one apart) and ``slot`` in the shard."""
    total = ranked.agg(F.count(F.lit(1))).first()[0] or 1
    shard: Column = F.expr(f"rank * {shards} div {total}")
    return (ranked.withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.col("rank") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")))


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id",
                 categories: tuple = ("lang", "source")) -> None:
    """The documents as Parquet, a folder per shard, rows in the order of their slots.

    Rows that agree in id, text and categories lie in one cell and take its places in any
    order: the nth of them takes the nth of their places. Such a group is numbered in one task.
    """
    text = whole_text("text").cast("binary")
    keys = {"_id": F.col(id_col), "_size": (F.octet_length(text) + 1).cast("long"), "_crc": F.crc32(text),
            **{f"_c{i}": F.col(c) for i, c in enumerate(categories)}}
    nth = F.row_number()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in keys.items()])
    rows = rows.withColumn("_nth", nth.over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    placed = sharded.withColumnsRenamed({"doc_id": "_id", "size": "_size", "text_crc32": "_crc"}).select(*keys, "shard", "slot")
    placed = placed.withColumn("_nth", nth.over(Window.partitionBy(*keys).orderBy("shard", "slot")))
    same = [rows[k].eqNullSafe(placed[k]) for k in [*keys, "_nth"]]
    (rows.join(placed, same).select("_row.*", "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .drop("slot").write.partitionBy("shard").parquet(path))


def digest(sharded: DataFrame) -> DataFrame:
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                          F.col("slot").cast("long").alias("slot"),
                          F.lit(None).cast("int").alias("grown_shard"), "cell")
