"""Which keys of a corpus occur in more than one document.

Documents are written once as blocks of rows (a bucketed table, so that later
steps group by block without an exchange). Each block sends the fingerprints of
its documents' keys, sorted, delta-coded and compressed, one value per key range
with the number of its documents that hold each; a task per range adds the
counts up and answers every block with those of its fingerprints that more than
one document holds. What travels is two to three bytes a distinct key, whatever
the keys are, and a key that every document holds costs a block one entry.

A fingerprint is the top bits of a 64-bit hash, 13 more than count the keys:
one unique key in some 8,000 is taken for a repeated one, never the reverse.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.llm.common import ROW_BITS, Workspace, partitions, whole_text

BLOCK_ROWS_BITS = 10  # documents of a block: 1,024
LONG_TEXT = 1 << 16  # bytes from which a text is a block of its own
SPARE_BITS = 13
SLICE_KEYS = 1 << 20  # keys of a range that are sorted at once
Docs = tuple[np.ndarray, np.ndarray]  # bytes of all texts, and where each begins (one more entry)


def write_blocks(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as a table bucketed by ``block``; ``rid`` numbers the rows and
    ``ord`` orders them by id (null ids last)."""
    at = F.monotonically_increasing_id()
    # the struct keeps the row as it was, but for the text, which the body holds
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("ord"),
                       whole_text(text_col).cast("binary").alias("body"), F.col(text_col).isNull().alias("no_text"),
                       at.alias("rid"))
    block = F.when(F.octet_length("body") >= LONG_TEXT, -F.col("rid") - 1).otherwise(
        F.shiftright("rid", BLOCK_ROWS_BITS))
    return ws.write_bucketed(rows.withColumn("block", block), "blocks", "block", partitions(docs.sparkSession))


def as_rows(rows: DataFrame, columns: list[str], text: Column | None = None, text_col: str = "text") -> DataFrame:
    """Rows of a blocks table with the documents' own columns again."""
    body = F.col("body").cast("string") if text is None else text
    return rows.select(*[F.when(~F.col("no_text"), body).alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                         for c in columns])


def key_bits(blocks: DataFrame, per_byte: float) -> int:
    """Bits of a fingerprint: what counts the corpus's keys, and ``SPARE_BITS``."""
    total = blocks.agg(F.sum(F.octet_length("body"))).first()[0] or 1
    return min(62, max(24, math.ceil(math.log2(max(2, total * per_byte))) + SPARE_BITS))


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers: differences as byte planes, compressed."""
    d = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    planes = d.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    d = np.zeros((planes.shape[1], 8), np.uint8)
    d[:, :width] = planes.T
    return np.cumsum(d.view("<u8")[:, 0], dtype=np.uint64)


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def doc_bytes(column: pa.ChunkedArray | pa.Array) -> Docs:
    """The texts of a binary column as one byte array, without copying where it is one chunk."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks) if a.num_chunks else pa.array([], pa.binary())
    wide = pa.types.is_large_binary(a.type)
    offsets = np.frombuffer(a.buffers()[1], np.int64 if wide else np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets


def runs_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of documents of about ``most`` bytes."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, stop
        start = stop


def _slices(sent: list[np.ndarray], most: int) -> Iterator[tuple[int, int]]:
    """Bounds [lo, hi) of stretches of the key space that hold about ``most`` of the
    keys: hashes spread evenly, so that equal stretches do."""
    total = sum(map(len, sent))
    if not total:
        return
    lo, end = min(int(k[0]) for k in sent if len(k)), max(int(k[-1]) for k in sent if len(k)) + 1
    n = -(-total // most)
    edges = [lo + (end - lo) * i // n for i in range(n + 1)]
    yield from ((a, b) for a, b in zip(edges, edges[1:]) if a < b)


def repeated_keys(blocks: DataFrame, keys: Callable[[np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]],
                  bits: int, ws: Workspace, slice_keys: int = SLICE_KEYS) -> DataFrame:
    """Per block (``block``, ``keys``, ``counts``): its fingerprints that occur in
    two documents or more, and in how many, packed; several rows a block.

    ``keys`` yields (document, its distinct 64-bit keys) for bytes and offsets.
    """
    ranges = partitions(blocks.sparkSession)
    shift = np.uint64(64 - bits)

    def collect(table: pa.Table) -> pa.Table:
        data, offsets = doc_bytes(table["body"])
        parts = [k >> shift for _, k in keys(data, offsets)]
        # a document's distinct keys may share a fingerprint: count it once per document
        parts = [np.unique(p) for p in parts]
        prints, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), [])
        prints = prints.astype(np.uint64)
        cut = np.searchsorted(prints, edges)
        counts = np.asarray(counts, np.uint32)
        live = [r for r in range(ranges) if cut[r + 1] > cut[r]]
        return pa.table({
            "range": pa.array(live, pa.int32()), "block": pa.array([table["block"][0].as_py()] * len(live), pa.int64()),
            "keys": pa.array([pack(prints[cut[r]:cut[r + 1]]) for r in live], pa.binary()),
            "counts": pa.array([squeeze(counts[cut[r]:cut[r + 1]]) for r in live], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        sent = [unpack(k) for k in table["keys"].to_pylist()]
        held = [expand(c, np.uint32) for c in table["counts"].to_pylist()]
        found = [([], []) for _ in sent]
        for lo, hi in _slices(sent, slice_keys):
            parts = [slice(*np.searchsorted(k, np.array([lo, hi], np.uint64))) for k in sent]
            prints = np.concatenate([k[p] for k, p in zip(sent, parts)])
            order = np.argsort(prints, kind="stable")
            prints = prints[order]
            first = np.flatnonzero(np.diff(prints, prepend=prints[:1] + np.uint64(1)))
            total = np.add.reduceat(np.concatenate([c[p] for c, p in zip(held, parts)])[order], first, dtype=np.int64)
            each = np.empty(len(prints), np.int64)
            each[order] = np.repeat(total, np.diff(first, append=len(prints)))
            at = 0
            for (keys, counts), k, p in zip(found, sent, parts):
                n = each[at:at + p.stop - p.start]
                at += len(n)
                keys.append(k[p][n > 1])
                counts.append(np.minimum(n[n > 1], 0xFFFFFFFF).astype(np.uint32))
        out = [(block, pack(np.concatenate(keys)), squeeze(np.concatenate(counts)))
               for block, (keys, counts) in zip(table["block"].to_pylist(), found) if sum(map(len, keys))]
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()),
                         "keys": pa.array([o[1] for o in out], pa.binary()),
                         "counts": pa.array([o[2] for o in out], pa.binary())})

    edges = np.array([(r << bits) // ranges for r in range(ranges + 1)], np.uint64)
    sent = blocks.select("block", "body").groupBy("block").applyInArrow(
        collect, "range int, block long, keys binary, counts binary")
    found = sent.groupBy("range").applyInArrow(answer, "block long, keys binary, counts binary")
    return ws.write(found, "repeated")


def reply(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All repeated fingerprints of a block, ascending, and their counts."""
    if not table.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    keys = np.concatenate([unpack(k) for k in table["keys"].to_pylist()])
    counts = np.concatenate([expand(c, np.uint32) for c in table["counts"].to_pylist()])
    order = np.argsort(keys)
    return keys[order], counts[order]


def look_up(prints: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many documents hold each fingerprint; 1 where only one does."""
    if not len(known):
        return np.ones(len(prints), np.uint32)
    at = np.minimum(np.searchsorted(known, prints), len(known) - 1)
    return np.where(known[at] == prints, counts[at], 1).astype(np.uint32)
