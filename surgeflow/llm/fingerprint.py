"""Document fingerprints: a quartile bucket digest.

From every window of five bytes six byte triplets (each holding the first byte)
are hashed into 256 buckets. Each bucket's count is coded by the quartile of
the counts it falls in (two bits), and the digest adds the text's length on a
log scale, the quartiles' ratios and a checksum. Two digests compare by a
difference score: steps between bucket codes (a step over all three quartiles
counts double) plus bounded terms for length, ratios and checksum; likeness is
one less that score over what unrelated texts reach, never below 0.

Texts are padded by four zero bytes, so that any text but the empty one has
windows; null counts as empty, whose buckets are all 0. Equal texts have equal
fingerprints. Work is per document in blocks of ``CHUNK_BYTES``; the pairing
with the next document needs one range exchange by id, and only the first and
last text of each partition travel further. Rows with equal ids are ordered by
their text's hash. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, partitions, whole_text

BUCKETS = 256
TRIPLETS = ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4))  # offsets beside the window's first byte
SALTS = (2, 3, 5, 7, 11, 13)
MULTIPLIER = 0x9E3779B1
LENGTH_BASE = 1.1
LENGTH_CAP, RATIO_CAP = 24, 14  # most that the length and the two ratios add
UNRELATED = 1.625 * BUCKETS  # mean step sum of independent codes with even quartiles
CHUNK_BYTES = 1 << 19


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (texts x buckets) and headers (texts x 4: checksum, length, ratios)."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join([t + b"\0\0\0\0" for t in texts]) + b"\0\0\0\0", np.uint8).astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.uint32), sizes + 4)
    m = len(doc)
    starts = np.concatenate([[0], np.cumsum(sizes + 4)])
    live = np.ones(m, bool)  # the pad holds no window
    for k in range(4):
        live[starts[1:] - 1 - k] = False
    at = np.flatnonzero(live)
    base, first = doc[at] * BUCKETS, data[at] << 16
    near = [None, *[data[at + k] for k in range(1, 5)]]
    counts = np.zeros(n * BUCKETS, np.int64)
    for salt, (i, j) in zip(SALTS, TRIPLETS):
        h = first | near[i] << 8 | near[j]
        h += np.uint32(salt << 24)
        h *= np.uint32(MULTIPLIER)
        h ^= h >> np.uint32(15)
        h *= np.uint32(MULTIPLIER)
        h >>= np.uint32(24)
        h += base
        counts += np.bincount(h, minlength=n * BUCKETS)
    counts = counts.reshape(n, BUCKETS)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1, None] for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    head = np.zeros((n, 4), np.int64)
    head[:, 0] = [t[0] if (t := hashlib.blake2b(x, digest_size=1).digest()) and x else 0 for x in texts]
    head[:, 1] = np.minimum(255, np.round(np.log(np.maximum(sizes, 1)) / np.log(LENGTH_BASE)))
    top = np.maximum(q3[:, 0], 1)
    head[:, 2], head[:, 3] = q1[:, 0] * 15 // top, q2[:, 0] * 15 // top
    return codes.astype(np.uint8), head


def spell(codes: np.ndarray, head: np.ndarray) -> list[str]:
    """Hexadecimal digests: checksum, length, ratios, then four buckets a byte."""
    c = codes.reshape(len(codes), -1, 4)
    body = (c[:, :, 0] << 6 | c[:, :, 1] << 4 | c[:, :, 2] << 2 | c[:, :, 3]).astype(np.uint8)
    lead = np.stack([head[:, 0], head[:, 1], head[:, 2] << 4 | head[:, 3]], 1).astype(np.uint8)
    return [x.tobytes().hex() for x in np.concatenate([lead, body], 1)]


def parse(digest: str) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(bytes.fromhex(digest), np.uint8)
    body = b[3:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3
    return body.reshape(1, -1), np.array([[b[0], b[1], b[2] >> 4, b[2] & 15]], np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    step = np.abs(a[0].astype(np.int16) - b[0].astype(np.int16))
    body = np.where(step == 3, 6, step).sum(1)
    far = np.abs(a[1] - b[1])
    extra = (np.minimum(far[:, 1], LENGTH_CAP) + np.minimum(far[:, 2] + far[:, 3], RATIO_CAP) + (far[:, 0] != 0))
    return np.maximum(0.0, 1.0 - (body + extra) / UNRELATED)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


FIELDS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare_rows(ids: pa.Array, texts: list[str], following: list[str]) -> Iterator[pa.RecordBatch]:
    """Result rows of documents and the texts that follow them."""
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size < CHUNK_BYTES):
            size += 2 * len(texts[stop]) + len(following[stop])
            stop += 1
        own = [t.encode() for t in texts[start:stop]]
        new = [edited(t, f).encode() for t, f in zip(texts[start:stop], following[start:stop])]
        nxt = [f.encode() for f in following[start:stop]]
        n = len(own)
        # in a run of rows each text follows the one before: its digest is computed once
        fresh = [i for i in range(n) if i == n - 1 or nxt[i] != own[i + 1]]
        codes, head = digests(own + new + [nxt[i] for i in fresh])
        a, e = (codes[:n], head[:n]), (codes[n:2 * n], head[n:2 * n])
        to = np.arange(1, n + 1)
        to[fresh] = 2 * n + np.arange(len(fresh))
        f = (codes[to], head[to])
        yield pa.RecordBatch.from_arrays(
            [ids.slice(start, n), pa.array([len(t) for t in texts[start:stop]], pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in new]), pa.array(spell(*a)), pa.array(spell(*e)),
             pa.array(likeness(a, e)), pa.array(likeness(a, f))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        start = stop


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one partition in order: results for all but the last, and the first
    and last texts, which meet their neighbours later."""
    part, held, seen = TaskContext.get().partitionId(), None, False

    def edge(kind: int, i: pa.Array, text: str) -> pa.RecordBatch:
        cols = [i, *[pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]]
        return pa.RecordBatch.from_arrays([*cols, pa.array([kind], pa.int32()), pa.array([part], pa.int64()), pa.array([text], pa.string())], names=NAMES)

    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        if not texts:
            continue
        if not seen:
            seen = True
            yield edge(1, ids.slice(0, 1), texts[0])
        if held:
            ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
        for rows in compare_rows(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:]):
            n = rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([0] * n, pa.int32()), pa.array([part] * n, pa.int64()), pa.nulls(n, pa.string())],
                names=NAMES)
        held = ids.slice(len(texts) - 1, 1), texts[-1]
    if held:
        yield edge(2, *held)


NAMES = ["doc_id", *[f.split()[0] for f in FIELDS.split(", ")], "kind", "part", "text"]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from compare_rows(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist())


def fingerprints(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its text with the last third replaced
    by the beginning of the next document (descending ids, nulls last, the first
    after the last), and the likeness of its own to either text's."""
    src = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    ordered = src.repartitionByRange(partitions(docs.sparkSession), *order[:2]).sortWithinPartitions(*order)
    rows = ws.write(ordered.mapInArrow(_in_order, f"doc_id {kind}, {FIELDS}, kind int, part long, text string"), "rows")
    # two rows a partition at most from here on
    by_part = Window.orderBy("part")
    first = rows.where("kind = 1").select("part", F.col("text").alias("following"))
    last = (rows.where("kind = 2").select("doc_id", "text", "part")
            .withColumn("then", F.coalesce(F.lead("part").over(by_part), F.min("part").over(Window.partitionBy()))))
    met = last.join(first.withColumnRenamed("part", "then"), "then").select("doc_id", "text", "following")
    return rows.where("kind = 0").drop("kind", "part", "text").unionByName(
        met.mapInArrow(_pairs, f"doc_id {kind}, {FIELDS}"))
