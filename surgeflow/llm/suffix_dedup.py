"""Suffix-array dedup by a distributed merge sort of front-coded suffix runs.

Every byte covered by a string of ``WINDOW`` (50) bytes that also starts in a
document with a smaller id is removed; strings are judged on the input.

The suffixes that are sorted are a content-defined subset, a sparse suffix
array: of the 24-byte strings in a window, the one with the smallest hash is the
window's anchor, the same wherever the window's bytes recur. A run of windows
with one anchor is one record: the suffix from the anchor to the run's end, the
few bytes before it, and how far the run reaches. Steps:

1. Anchors that only one document holds go (``repeats``): a window that recurs
   in another document has its anchor there too.
2. Each block sorts its records; of equal ones only those of the smallest id
   travel (the others are settled on the spot), so that a passage which every
   document holds is one entry per block. Sorted runs are cut at splitters and
   exchanged front-coded: each suffix as the length of the prefix it shares with
   the one before, and the rest.
3. A task per key range merges its runs by a loser tree over common-prefix
   lengths: a loser keeps what it shares with its winner, so that lengths alone
   settle most matches, and bytes are looked at only beyond the known prefix.
4. In the merged order, records with the same suffix are neighbours; with the
   same bytes before the anchor they hold the same window, whose smallest id
   marks all others.

Null texts count as empty. Matches never cross documents, nor does a document
match itself or rows with its own id; null ids count as the largest. Texts under
50 bytes stay whole. Rows keep their multiplicity and their other columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeflow.llm import repeats as R
from surgeflow.llm.common import Workspace, partitions
from surgeflow.llm.ngram_join import mix

WINDOW = 50
GRAM = 24
SPAN = WINDOW - GRAM + 1  # anchors a window chooses from: 27
LEFT = SPAN - 1  # most bytes of a window before its anchor
CHUNK_BYTES = 1 << 20
POS_BITS = 22  # of a place in a chunk, below the hash that is minimised
LONGEST = 1 << POS_BITS
MIX = np.uint64(0x9E3779B97F4A7C15)
WORD_BYTES = 8
WORDS = -(-WINDOW // WORD_BYTES)
AHEAD = 128


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 24 bytes from every place (the last 23 places: rubbish)."""
    h = data.astype(np.uint64) + np.uint64(1)
    sizes = {}
    k = 1
    while k < 16:
        n = len(h) - k
        g = h.copy()
        g[:n] = h[:n] * (MIX + np.uint64(2 * k)) + h[k:]
        g ^= g >> np.uint64(29)
        h, k = g, 2 * k
        sizes[k] = h
    h16, h8 = sizes[16], sizes[8]
    out = h16.copy()
    n = max(0, len(h16) - 16)
    out[:n] = h16[:n] * (MIX + np.uint64(77)) + h8[16:]
    return mix(out)


def _smallest(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum of ``span`` values from every place."""
    m, k = key, 1
    while 2 * k <= span:
        n = np.full(len(m), ~np.uint64(0))
        n[:len(m) - k] = m[k:]
        m, k = np.minimum(m, n), 2 * k
    rest = span - k
    n = np.full(len(m), ~np.uint64(0))
    n[:len(m) - rest] = m[rest:]
    return np.minimum(m, n)


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, behind the last, first byte, behind the last) to work on at once;
    of a text over ``LONGEST`` bytes, stretches that overlap by a window."""
    for a, b in R.runs_of(offsets, CHUNK_BYTES):
        lo, hi = int(offsets[a]), int(offsets[b])
        while hi - lo > LONGEST:
            yield a, b, lo, lo + LONGEST
            lo += LONGEST - WINDOW + 1
        yield a, b, lo, hi


def anchored_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (text, first window, last window, anchor, anchor's hash) of the runs
    of windows that share an anchor; places count over all bytes."""
    for a, b, lo, hi in _pieces(offsets):
        if hi - lo < WINDOW:
            continue
        part = data[lo:hi]
        h = gram_hashes(part)
        key = (h >> np.uint64(POS_BITS) << np.uint64(POS_BITS)) | np.arange(len(h), dtype=np.uint64)
        at = (_smallest(key, SPAN) & np.uint64(LONGEST - 1)).astype(np.int64)
        bounds = np.clip(offsets[a:b + 1] - lo, 0, hi - lo)
        doc = np.repeat(np.arange(a, b), np.diff(bounds))
        room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(hi - lo)
        p = np.flatnonzero(room >= WINDOW)
        if not len(p):
            continue
        x, d = at[p], doc[p]
        new = np.ones(len(p), bool)
        new[1:] = (x[1:] != x[:-1]) | (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)
        s = np.flatnonzero(new)
        e = np.append(s[1:], len(p)) - 1
        yield d[s], p[s] + lo, p[e] + lo, x[s] + lo, h[x[s]]


def anchor_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(text, the distinct hashes of its anchors)."""
    for d, _, _, _, h in anchored_runs(data, offsets):
        order = np.lexsort((h, d))
        d, h = d[order], h[order]
        keep = np.ones(len(d), bool)
        keep[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
        d, h = d[keep], h[keep]
        cut = np.flatnonzero(np.diff(d, prepend=-1))
        for i, j in zip(cut, np.append(cut[1:], len(d))):
            yield int(d[i]), h[i:j]


def _context(data: np.ndarray, p0: np.ndarray, p1: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A row per record: suffix (50 bytes, zero behind the run's end), its length,
    the bytes before the anchor nearest first (26, zero before the run), their number."""
    right, left = p1 + WINDOW - x, x - p0
    k = np.arange(WINDOW)
    s = data[np.minimum(x[:, None] + k, len(data) - 1)]
    s[k >= right[:, None]] = 0
    k = np.arange(LEFT)
    b = data[np.maximum(x[:, None] - 1 - k, 0)]
    b[k >= left[:, None]] = 0
    return np.concatenate([s, right[:, None].astype(np.uint8), b, left[:, None].astype(np.uint8)], 1)


ROW = WINDOW + 1 + LEFT + 1


def _order(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}")[:, 0], kind="stable")


def _shared(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the one before (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        same = rows[1:] == rows[:-1]
        out[1:] = np.where(same.all(1), rows.shape[1], same.argmin(1))
    return out


def _range_key(rows: np.ndarray) -> np.ndarray:
    """The anchors, the first 24 bytes, in byte order: records that may share a window
    have the same, so that ranges can be cut at any of them."""
    return np.ascontiguousarray(rows[:, :GRAM]).view(f"S{GRAM}")[:, 0]


class Run:
    """A sorted run of suffix records and where they occur."""

    def __init__(self, rows, ord_, rec, rid, pos):
        self.rows, self.ord, self.rec, self.rid, self.pos = rows, ord_, rec, rid, pos

    def pack(self) -> bytes:
        """Front-coded suffixes, then the columns beside them, compressed."""
        suffix = self.rows[:, :WINDOW]
        lcp = _shared(suffix)
        size = self.rows[:, WINDOW].astype(np.int64)
        k = np.arange(WINDOW)
        rest = suffix[(k >= lcp[:, None]) & (k < size[:, None])]
        parts = [np.array([len(self.rows), len(self.rec), len(rest)], np.int64), lcp.astype(np.uint8), rest,
                 self.rows[:, WINDOW:], self.ord, self.rec.astype(np.int32), self.rid, self.pos]
        return R.squeeze(np.frombuffer(b"".join(np.ascontiguousarray(x).tobytes() for x in parts), np.uint8))

    @staticmethod
    def unpack(data: bytes) -> tuple[Run, np.ndarray]:
        b = R.expand(data, np.uint8)
        n, occ, m = np.frombuffer(b, np.int64, 3)
        at = 24

        def take(count, dtype):
            nonlocal at
            out = np.frombuffer(b, dtype, count, at)
            at += out.nbytes
            return out

        lcp, rest = take(n, np.uint8).astype(np.int64), take(m, np.uint8)
        tail = take(n * (ROW - WINDOW), np.uint8).reshape(n, -1)
        size = tail[:, 0].astype(np.int64)
        rows = np.zeros((n, ROW), np.uint8)
        rows[:, WINDOW:] = tail
        k = np.arange(WINDOW)
        own = (k >= lcp[:, None]) & (k < size[:, None])
        suffix = np.zeros((n, WINDOW), np.uint8)
        suffix[own] = rest
        # a shared byte stands where the last row before wrote its own
        source = np.maximum.accumulate(np.where((k >= lcp[:, None]), np.arange(n)[:, None], 0), axis=0)
        rows[:, :WINDOW] = suffix[source, k]
        return Run(rows, take(n, np.int64), take(occ, np.int32), take(occ, np.int64), take(occ, np.int32)), lcp


def merge_order(runs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Order in which the suffixes of all runs (rows, shared prefixes; counted run
    after run) come when merged, by a loser tree.

    Prefix lengths count words of eight bytes. Each inner node holds the loser of
    its match and the words it shares with the winner that passed; the next
    suffix of the winner's run comes with what it shares with its forerunner. Of
    two suffixes the one that shares more with the last output is the smaller;
    only if both share as much are words compared, from there on. Of each run only
    the next ``AHEAD`` suffixes are held as words.
    """
    total = sum(len(r) for r, _ in runs)
    if len(runs) == 1:
        return np.arange(total)
    words, known, heads, ends = [None] * total, [], [], []
    at = 0

    def ahead(run: int, at: int) -> None:
        rows = runs[run][0][at - heads[run]:][:AHEAD]
        wide = np.zeros((len(rows), WORDS * WORD_BYTES), np.uint8)
        wide[:, :WINDOW] = rows[:, :WINDOW]
        words[at:at + len(rows)] = map(tuple, wide.view(">u8").astype(np.uint64).tolist())
        past = max(heads[run], at - AHEAD)
        words[past:at] = [None] * (at - past)

    for i, (rows, lcp) in enumerate(runs):
        known += (lcp // WORD_BYTES).tolist()
        heads.append(at)
        if len(rows):
            ahead(i, at)
        at += len(rows)
        ends.append(at)
    k = 1
    while k < len(runs):
        k *= 2
    done = (None,)  # behind the last suffix of a run
    head = heads + [total] * (k - len(runs))  # a list of its own
    end = ends + [total] * (k - len(runs))
    loser, share = [0] * k, [0] * k
    win = [0] * (2 * k)
    win[k:] = range(k)
    for node in range(k - 1, 0, -1):
        a, b = win[2 * node], win[2 * node + 1]
        if head[b] >= end[b] or (head[a] < end[a] and words[head[a]] <= words[head[b]]):
            w, s = a, b
        else:
            w, s = b, a
        win[node], loser[node] = w, s
        if head[s] < end[s]:
            x, y, h = words[head[w]], words[head[s]], 0
            while h < WORDS and x[h] == y[h]:
                h += 1
            share[node] = h
        else:
            share[node] = -1
    out, run = [0] * total, win[1]
    for i in range(total):
        at = head[run]
        out[i] = at
        at += 1
        head[run] = at
        if at < end[run]:
            if words[at] is None:
                ahead(run, at)
            h, x = known[at], words[at]
        else:
            h, x = -1, done
        node = (run + k) >> 1
        while node:
            s = share[node]
            if s > h:  # the loser shares more with the last output: it wins now
                loser[node], run = run, loser[node]
                share[node], h = h, s
                x = words[head[run]]
            elif s == h and h >= 0:
                other = loser[node]
                y = words[head[other]]
                while h < WORDS and x[h] == y[h]:
                    h += 1
                # ``h`` is what they share; what each shares with the last output was ``s``
                if h < WORDS and y[h] < x[h]:
                    loser[node], run = run, other
                    x = y
                share[node], h = h, s
            node >>= 1
    return np.array(out)


def _cut(values: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    return np.searchsorted(values, splitters, "left")


def _windows(rid, x, rows, marks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rid, from, to) byte spans of the marked windows of occurrences: ``marks``
    has a column per distance of a window's start before the anchor."""
    occ, before = np.nonzero(marks)
    start = x[occ] - before
    return rid[occ], start, start + WINDOW


def _spans(rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of byte spans per row."""
    if not len(rid):
        return rid, lo, hi
    order = np.lexsort((lo, rid))
    rid, lo, hi = rid[order], lo[order], hi[order]
    far = np.maximum.accumulate(hi + (np.cumsum(np.diff(rid, prepend=rid[0]) != 0) << 40)) & ((1 << 40) - 1)
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (lo[1:] > far[:-1])
    s = np.flatnonzero(new)
    return rid[s], lo[s], far[np.append(s[1:], len(rid)) - 1]


def _marks_table(block: np.ndarray, rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Table:
    """Spans packed, a row per block."""
    order = np.argsort(block, kind="stable")
    block, rid, lo, hi = block[order], rid[order], lo[order], hi[order]
    cut = np.flatnonzero(np.diff(block, prepend=block[0] - 1)) if len(block) else np.zeros(0, np.int64)
    packed = []
    for i, j in zip(cut, np.append(cut[1:], len(block))):
        packed.append(R.squeeze(np.stack([*_spans(rid[i:j], lo[i:j], hi[i:j])]).astype(np.int64)))
    return pa.table({"block": pa.array(block[cut], pa.int64()), "marks": pa.array(packed, pa.binary())})


def record_runs(blocks: DataFrame, repeated: DataFrame, bits: int, splitters: list[bytes]) -> DataFrame:
    """Per block its sorted records cut into key ranges (``range``, ``run``), and
    the marks that the block alone can tell (``settled``), dealt over the ranges."""
    shift, cuts = np.uint64(64 - bits), np.array(splitters, f"S{GRAM}")

    def build(left: pa.Table, right: pa.Table) -> pa.Table:
        known, _ = R.reply(right)
        data, offsets = R.doc_bytes(left["body"])
        rids = left["rid"].to_numpy()
        ords = left["ord"].to_numpy()
        block = left["block"][0].as_py() if left.num_rows else 0
        parts = [[] for _ in range(5)]
        for d, p0, p1, x, h in anchored_runs(data, offsets) if len(known) else ():
            keep = R.look_up(h >> shift, known, np.full(len(known), 2, np.uint32)) > 1
            for part, v in zip(parts, (d, p0, p1, x)):
                part.append(v[keep])
        ranges, packed = [], []
        marks = pa.table({"block": pa.array([], pa.int64()), "marks": pa.array([], pa.binary())})
        if parts[0] and sum(map(len, parts[0])):
            d, p0, p1, x = (np.concatenate(p) for p in parts[:4])
            rows = _context(data, p0, p1, x)
            order = np.lexsort((p0, ords[d]))
            order = order[_order(rows[order])]
            rows, d, x = rows[order], d[order], x[order]
            new = _shared(rows) < ROW
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            own = ords[d] == ords[d[first]][group]  # of the smallest id in the block
            place = x - offsets[d]
            # the others' windows all recur in a smaller id of this block
            late = np.flatnonzero(~own)
            if len(late):
                m = _reach(rows[late])
                marks = _marks_table(*(lambda r, lo, hi: (np.full(len(r), block), r, lo, hi))(
                    *_windows(rids[d[late]], place[late], rows[late], m)))
            keep = np.flatnonzero(own)
            rec, rid, pos = group[keep], rids[d[keep]], place[keep].astype(np.int32)
            rows, ord_ = rows[first], ords[d[first]]
            cut = np.concatenate([[0], _cut(_range_key(rows), cuts), [len(rows)]])
            at = np.searchsorted(rec, cut)
            for r in range(len(cut) - 1):
                i, j = cut[r], cut[r + 1]
                if j > i:
                    a, b = at[r], at[r + 1]
                    ranges.append(r)
                    packed.append(Run(rows[i:j], ord_[i:j], rec[a:b] - i, rid[a:b], pos[a:b]).pack())
        n, m = len(ranges), marks.num_rows
        return pa.table({"range": pa.array([*ranges, *[block % (len(cuts) + 1)] * m], pa.int32()),
                         "block": pa.array([block] * (n + m), pa.int64()),
                         "settled": pa.array([False] * n + [True] * m, pa.bool_()),
                         "run": pa.array([*packed, *marks["marks"].to_pylist()], pa.binary())})

    return (blocks.select("block", "rid", "ord", "body").groupBy("block")
            .cogroup(repeated.groupBy("block")).applyInArrow(build, "range int, block long, settled boolean, run binary"))


def _reach(rows: np.ndarray) -> np.ndarray:
    """Which distances before the anchor a record's windows start at (rows x 27)."""
    k = np.arange(SPAN)
    least = WINDOW - rows[:, WINDOW].astype(np.int64)
    most = rows[:, ROW - 1].astype(np.int64)
    return (k >= least[:, None]) & (k <= most[:, None])


def shared_windows(rows: np.ndarray, ords: np.ndarray) -> np.ndarray:
    """For records in suffix order: which of their windows occur with a smaller id."""
    n = len(rows)
    reach = _reach(rows)
    out = np.zeros_like(reach)
    right = _shared(rows[:, :WINDOW])
    before = rows[:, WINDOW + 1:WINDOW + 1 + LEFT]
    by_left = _order(before)
    left = np.empty(n, np.int64)
    lcp_left = _shared(before[by_left])
    for k in range(SPAN):
        on = np.flatnonzero(reach[:, k])
        if len(on) < 2:
            continue
        suffix_class = np.cumsum(right < WINDOW - k)
        left[by_left] = np.cumsum(lcp_left < k)
        key = suffix_class[on] * (n + 1) + left[on]
        order = np.argsort(key, kind="stable")
        key, o = key[order], ords[on[order]]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        low = np.minimum.reduceat(o, first)[np.cumsum(new) - 1]
        out[on[order], k] = low < o
    return out


def merge_ranges(runs: DataFrame) -> DataFrame:
    """Marks (``block``, packed spans) from the merged runs of each key range, and
    those that were settled before. The runs are exchanged once and never stored."""

    def merge(table: pa.Table) -> pa.Table:
        settled = table.filter(table["settled"]).select(["block", "run"]).rename_columns(["block", "marks"])
        table = table.filter(pa.compute.invert(table["settled"]))
        if not table.num_rows:
            return settled
        runs = [Run.unpack(r) for r in table["run"].to_pylist()]
        order = merge_order([(r.rows, lcp) for r, lcp in runs])
        rows = np.concatenate([r.rows for r, _ in runs])
        ords = np.concatenate([r.ord for r, _ in runs])
        marks = np.zeros((len(rows), SPAN), bool)
        marks[order] = shared_windows(rows[order], ords[order])
        hit = marks.any(1)
        base, out = 0, [[] for _ in range(4)]
        for block, (r, _) in zip(table["block"].to_pylist(), runs):
            rec = r.rec + base
            on = np.flatnonzero(hit[rec])
            got = _windows(r.rid[on], r.pos[on].astype(np.int64), None, marks[rec[on]])
            for part, v in zip(out, (np.full(len(got[0]), block), *_spans(*got))):
                part.append(v[:len(got[0])])
            out[0][-1] = np.full(len(out[1][-1]), block)
            base += len(r.rows)
        return pa.concat_tables([settled, _marks_table(*(np.concatenate(p).astype(np.int64) for p in out))])

    return runs.groupBy("range").applyInArrow(merge, "block long, marks binary")


def splitters(blocks: DataFrame, ranges: int, ws: Workspace) -> list[bytes]:
    """Boundaries of about equal key ranges, from anchors of every 16th part of the texts:
    the least key of each partition of a range exchange. As whole anchors are compared, keys
    that begin alike are split too. They set only which task sorts a suffix, never a result."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = R.doc_bytes(b.column(0))
            for _, _, p1, x, h in anchored_runs(data, offsets):
                on = np.flatnonzero(h % np.uint64(64) == 0)
                keys = _context(data, x[on], p1[on], x[on])[:, :GRAM]
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary())], names=["key"])

    sample = ws.write(blocks.where(F.xxhash64("rid") % 16 == 0).select("body").mapInArrow(draw, "key binary"), "sample")
    parts = sample.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
    return sorted({bytes(r.key) for r in parts.collect()})[1:]  # as many rows as there are ranges


def removed_spans(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Marks per block, and the documents in blocks."""
    blocks = R.write_blocks(docs, ws, id_col, text_col)
    bits = R.key_bits(blocks, 2 / (SPAN + 1))
    repeated = R.repeated_keys(blocks, anchor_sets, bits, ws)
    runs = record_runs(blocks, repeated, bits, splitters(blocks, partitions(docs.sparkSession), ws))
    return ws.write(merge_ranges(runs), "marks"), blocks


def strip(blocks: DataFrame, marks: DataFrame, keep_row: bool = False) -> DataFrame:
    """Per document: ``ord``, ``n_bytes``, ``starts`` and ``ends`` of the removed
    runs, ``kept`` (remaining bytes); with ``keep_row`` its other columns as ``row``
    and ``kept_text`` (the remaining bytes without those of characters cut apart)."""
    row = [f for f in blocks.schema.fields if f.name == "row"] if keep_row else []

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [R.expand(m, np.int64).reshape(3, -1) for m in right["marks"].to_pylist()]
        rid, lo, hi = _spans(*np.concatenate(found, 1)) if found else (np.zeros(0, np.int64),) * 3
        rids = left["rid"].to_numpy()
        kept, starts, ends, sizes = [], [], [], []
        for r, body in zip(rids, left["body"].to_pylist()):
            i, j = np.searchsorted(rid, r), np.searchsorted(rid, r, "right")
            s, e = lo[i:j], hi[i:j]
            at, rest = 0, []
            for a, b in zip(s.tolist(), e.tolist()):
                rest.append(body[at:a])
                at = b
            rest.append(body[at:])
            kept.append(b"".join(rest))
            starts.append(s)
            ends.append(e)
            sizes.append(len(body))
        cols = {"ord": left["ord"], "n_bytes": pa.array(sizes, pa.int64()), "starts": pa.array(starts, pa.list_(pa.int64())),
                "ends": pa.array(ends, pa.list_(pa.int64())), "kept": pa.array(kept, pa.binary())}
        if row:
            text = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            cols |= {"row": left["row"], "no_text": left["no_text"], "kept_text": text}
        return pa.table(cols)

    shape = "ord long, n_bytes long, starts array<long>, ends array<long>, kept binary"
    if row:
        shape += f", row {row[0].dataType.simpleString()}, no_text boolean, kept_text string"
    cols = ["block", "rid", "ord", "body", *(["row", "no_text"] if row else [])]
    return blocks.select(*cols).groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(cut, shape)


def digest(stripped: DataFrame) -> DataFrame:
    total = F.expr("aggregate(zip_with(starts, ends, (a, b) -> b - a), 0L, (x, y) -> x + y)")
    return stripped.select(
        F.when(F.col("ord") != (1 << 63) - 1, F.col("ord")).alias("doc_id"), "n_bytes", total.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (
  SELECT doc_id, base, substr(h, 2 * base + 1, 354) AS part FROM (
    SELECT doc_id, h, unnest(range(0, length(h) // 2, 128)) AS base FROM docs)),
bytes AS (
  SELECT doc_id, base + k AS i, substr(part, 2 * k + 1, 100) AS w FROM (
    SELECT doc_id, base, part, unnest(range(least(128, length(part) // 2))) AS k FROM parts)),
least_ids AS (SELECT w, min(doc_id) AS least FROM bytes WHERE length(w) = 100 GROUP BY w),
late AS (SELECT doc_id, i FROM bytes JOIN least_ids USING (w) WHERE least < doc_id),
marked AS (
  SELECT b.doc_id, b.i, substr(w, 1, 2) AS byte, max(CASE WHEN l.i IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY b.doc_id ORDER BY b.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM bytes b LEFT JOIN late l ON l.doc_id = b.doc_id AND l.i = b.i),
runs AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM marked),
kept AS (
  SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, count(*) FILTER (gone > before) AS n_spans,
         string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS rest
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


def brute_force(texts: dict[int, str | None]) -> dict[int, tuple]:
    """The same result by a table of all 50-byte strings, for small corpora."""
    first: dict[bytes, int] = {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        for p in range(len(b) - WINDOW + 1):
            first.setdefault(b[p:p + WINDOW], i)
    out = {}
    for i, t in texts.items():
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - WINDOW + 1):
            if first[b[p:p + WINDOW]] < i:
                gone[p:p + WINDOW] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])[:len(b)]).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out
