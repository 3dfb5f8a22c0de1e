"""Ranked lexical search over a length-stratified index.

A document's score for an item is the sum, over the item's terms with repeats, of
w * ((1000000000 * tf) div (1000 * tf + 12 * m)); m grows with the document's
length against the mean, w with the rarity of the term (the module's contract is
integer arithmetic but for the logarithm in w). Steps, all jobs on Spark:

1. ``term_counts`` reads every whole text once: its length in terms, and how
   often it holds each term that an item asks for. Lengths, document frequencies
   and totals come from that table by ordinary aggregates.
2. ``stratified_index`` sorts the documents by m (range exchange, hashed within
   equal m, so that a hot m is spread) and cuts them into segments: documents of
   one m, a stratum or, of a large one, a part of it. As m is one number there,
   a posting's impact depends on term and tf alone: a segment's postings stand by
   term and falling tf, and the impact is computed once for each tf. With each
   segment go the items' bounds: what a document with every term's highest tf in
   the segment would score.
3. ``search`` visits segments in the order of their bounds, in two rounds: each
   item's ``FIRST`` highest give its k-th score so far, and of the others only
   those are met whose bound reaches it. Within a task an item's running k-th
   score closes further segments. Nothing that could be among the k is left out.

Items are worked on in blocks of about ``BLOCK_BYTES`` of text, so that what a
task holds of them is bounded; each block reads the documents again.

Null texts have no terms; such documents are not counted and never found. Null
document ids come behind all others among equal scores and are returned as null.
Rows with one id are documents of their own. Equal rows of items count once; items
of one id and different texts are ranked each. An empty table of either kind gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, partitions, whole_text

K = 20
FIRST = 8  # segments of each item that are visited in the first round
SEGMENT_DOCS = 4096
BLOCK_BYTES = 1 << 20
CHUNK_BYTES = 1 << 20
EXACT = 1 << 53  # whole numbers below it are exact as doubles
NO_ID = (1 << 63) - 1

# byte -> what it is as part of a term: itself, its lower case, or a separator
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    at = 0
    while at < len(text):
        stop = at + CHUNK_BYTES
        part = text[at:stop].translate(_FOLD)
        if stop < len(text) and part[-1] != 32:  # on to the end of the term that is cut
            while stop < len(text) and _FOLD[text[stop]] != 32:
                stop += 1
            part = text[at:stop].translate(_FOLD)
        yield part.split()
        at = stop


def term_counts(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with a term at all: ``ord`` (its id, null last), ``n``
    (its terms with repeats), ``terms`` (numbers of those in ``terms`` that it
    holds, ascending) and ``tfs``."""
    number = {t: i for i, t in enumerate(terms)}
    asked = frozenset(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, sizes, held, tfs, ends = [], [], [], [], [0]
            for ord_, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, seen = 0, Counter()
                for part in terms_of(body.as_py()):
                    n += len(part)
                    seen.update(part)
                if not n:
                    continue
                own = sorted((number[t], seen[t]) for t in asked & seen.keys())
                ords.append(ord_)
                sizes.append(n)
                held += [i for i, _ in own]
                tfs += [c for _, c in own]
                ends.append(len(held))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ords, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(held, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["ord", "n", "terms", "tfs"])

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("ord"),
                      whole_text(text_col).cast("binary").alias("body"))
    return src.mapInArrow(count, "ord long, n long, terms array<int>, tfs array<long>")


def weights(counts: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents, their terms together, weight of each asked term). One row a term
    of the block of items reaches the driver."""
    total = counts.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = np.zeros(n_terms, np.int64)
    for r in df.toLocalIterator():
        w[r["term"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * r["df"] + 1)))
    return total["docs"], total["terms"], w


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Items:
    """Term numbers and how often each item repeats them, one after another."""

    def __init__(self, asked: list[dict[int, int]], w: np.ndarray):
        self.ends = np.cumsum([0, *map(len, asked)])
        self.term = np.array([t for a in asked for t in a], np.int64)
        self.weight = w[self.term] * np.array([c for a in asked for c in a.values()], np.int64)

    def bounds(self, top: np.ndarray) -> np.ndarray:
        """Each item's score of a document that has every term's impact ``top``."""
        total = np.concatenate([[0], np.cumsum(self.weight * top[self.term])])
        return total[self.ends[1:]] - total[self.ends[:-1]]


class Segment:
    """Documents of one m and their postings by term and falling tf."""

    FIELDS = "ords binary, terms binary, ends binary, docs binary, impacts binary"

    def __init__(self, ords, terms, ends, docs, impact):
        self.ords, self.terms, self.ends, self.docs, self.impact = ords, terms, ends, docs, impact

    @staticmethod
    def of(m: int, ords: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> Segment:
        doc = np.repeat(np.arange(len(ords)), np.diff(ends))
        order = np.lexsort((doc, -tfs, terms))
        term, doc, tf = terms[order], doc[order], tfs[order]
        own, first = np.unique(term, return_index=True)
        kinds, at = np.unique(tf, return_inverse=True)
        return Segment(ords, own, np.append(first, len(term)), doc, impacts(kinds, m)[at])

    def pack(self) -> list[bytes]:
        return [a.tobytes() for a in (self.ords.astype(np.int64), self.terms.astype(np.int32), self.ends.astype(np.int32),
                                      self.docs.astype(np.uint16), self.impact.astype(np.int64))]

    @staticmethod
    def unpack(parts: list[bytes]) -> Segment:
        kinds = (np.int64, np.int32, np.int32, np.uint16, np.int64)
        return Segment(*(np.frombuffer(p, k) for p, k in zip(parts, kinds)))

    def tops(self, n_terms: int) -> np.ndarray:
        out = np.zeros(n_terms, np.int64)
        out[self.terms] = self.impact[self.ends[:-1]]  # the highest tf stands first
        return out

    def scores(self, term: np.ndarray, weight: np.ndarray, bound: int) -> np.ndarray:
        """Score of each document for one item."""
        out = np.zeros(len(self.ords), np.int64)
        if not len(self.terms):
            return out
        at = np.searchsorted(self.terms, term)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == term
        lo, hi = self.ends[at[known]].astype(np.int64), self.ends[at[known] + 1].astype(np.int64)
        size = hi - lo
        place = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        got = self.impact[place] * np.repeat(weight[known], size)
        if bound < EXACT:
            return np.bincount(self.docs[place], got, len(out)).astype(np.int64)
        np.add.at(out, self.docs[place], got)
        return out


def stratified_index(counts: DataFrame, n_docs: int, n_terms: int, items: Items, ws: Workspace, name: str,
                     segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """Segments in the order of m: ``segment``, ``m``, ``n_docs``, packed postings,
    and the ``bounds`` of the items that have any there (``item``, ``bound``)."""
    vocabulary = len(items.term) and int(items.term.max()) + 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def segment(m: int) -> pa.RecordBatch:
            nonlocal made
            sizes = np.concatenate([h[1] for h in held])
            s = Segment.of(m, np.concatenate([h[0] for h in held]), np.concatenate([[0], np.cumsum(sizes)]),
                           np.concatenate([h[2] for h in held]).astype(np.int64), np.concatenate([h[3] for h in held]))
            bounds = items.bounds(s.tops(vocabulary))
            on = np.flatnonzero(bounds)
            made += 1
            ends = pa.array([0, len(on)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([m], pa.int64()), pa.array([len(s.ords)], pa.int64()),
                 *[pa.array([b], pa.binary()) for b in s.pack()],
                 pa.ListArray.from_arrays(ends, pa.array(on, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(bounds[on], pa.int64()))],
                names=["segment", "m", "n_docs", "ords", "terms", "ends", "docs", "impacts", "items", "bounds"])

        m, n = None, 0
        for b in batches:
            ms, ords = b.column(0).to_numpy(), b.column(1).to_numpy()
            ends = b.column(2).offsets.to_numpy()
            terms, tfs = b.column(2).values.to_numpy(), b.column(3).values.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ms)) + 1).tolist(), len(ms)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if held and (ms[i] != m):
                    yield segment(m)
                    held, n = [], 0
                m = int(ms[i])
                while i < j:
                    k = min(j, i + segment_docs - n)
                    held.append((ords[i:k], np.diff(ends[i:k + 1]), terms[ends[i]:ends[k]], tfs[ends[i]:ends[k]]))
                    n, i = n + k - i, k
                    if n == segment_docs:
                        yield segment(m)
                        held, n = [], 0
        if held:
            yield segment(m)

    m = F.expr(f"75 + (25 * n * {n_docs}L) div {max(1, n_terms)}L")
    # documents without an asked term can't be found; equal m are dealt by hash, so that a hot one is spread
    placed = counts.where("size(terms) > 0").select(m.alias("m"), "ord", "terms", "tfs", F.xxhash64("ord", "terms", "tfs").alias("h"))
    ordered = placed.repartitionByRange(partitions(counts.sparkSession), "m", "h").sortWithinPartitions("m", "h")
    index = ordered.select("m", "ord", "terms", "tfs").mapInArrow(
        build, f"segment long, m long, n_docs long, {Segment.FIELDS}, items array<int>, bounds array<long>")
    return ws.write(index, name)


def visit(index: DataFrame, visits: DataFrame, items: Items, k: int) -> DataFrame:
    """Scores of the documents of visited segments: (``item``, ``score``, ``ord``), the
    best ``k`` of each item in a task. ``visits``: segment, item, bound, least (the
    score below which nothing counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1)
                s = Segment.unpack([row.column(c)[0].as_py() for c in range(5)])
                for v in row.column(5)[0].as_py():
                    i, least = v["item"], max(1, v["least"])
                    score, ord_ = best.get(i, (np.zeros(0, np.int64),) * 2)
                    if len(score) >= k:
                        least = max(least, int(score[k - 1]))
                    if v["bound"] < least:
                        continue
                    own = slice(items.ends[i], items.ends[i + 1])
                    got = s.scores(items.term[own], items.weight[own], v["bound"])
                    on = np.flatnonzero(got >= least)
                    score, ord_ = np.concatenate([score, got[on]]), np.concatenate([ord_, s.ords[on]])
                    order = np.lexsort((ord_, -score))[:k]
                    best[i] = score[order], ord_[order]
        for i, (score, ord_) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(score), pa.int32()), pa.array(score), pa.array(ord_)],
                                             names=["item", "score", "ord"])

    todo = visits.groupBy("segment").agg(F.collect_list(F.struct("item", "bound", "least")).alias("visits"))  # a block's items at most
    met = index.select("segment", "ords", "terms", "ends", "docs", "impacts").join(todo, "segment").drop("segment")
    return met.mapInArrow(run, "item int, score long, ord long")


def ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "ord", "tie")
    return (hits.withColumn("tie", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).drop("tie"))


def search_block(docs: DataFrame, block: list[tuple], ws: Workspace, name: str, k: int = K, id_col: str = "doc_id",
                 text_col: str = "text", first_segments: int = FIRST, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """(``item`` (place in ``block``), ``rank``, ``ord``, ``score``) for a bounded list of (id, text)."""
    asked = [Counter(t for part in terms_of((text or "").encode()) for t in part) for _, text in block]
    terms = sorted(set().union(*asked))
    number = {t: i for i, t in enumerate(terms)}
    counts = ws.write(term_counts(docs, terms, id_col, text_col), f"{name}-counts")
    n_docs, n_terms, w = weights(counts, len(terms))
    items = Items([{number[t]: c for t, c in a.items()} for a in asked], w)
    index = stratified_index(counts, n_docs, n_terms, items, ws, f"{name}-index", segment_docs)

    bounds = index.select("segment", F.explode(F.arrays_zip("items", "bounds")).alias("b")).select(
        "segment", F.col("b.items").alias("item"), F.col("b.bounds").alias("bound"))
    turn = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "segment"))
    bounds = ws.write(bounds.withColumn("turn", turn), f"{name}-bounds")
    first = ws.write(ranked(visit(index, bounds.where(F.col("turn") <= first_segments).withColumn("least", F.lit(1).cast("long")), items, k), k),
                     f"{name}-first")
    kth = first.where(F.col("rank") == k).select("item", F.col("score").alias("least"))
    rest = (bounds.where(F.col("turn") > first_segments).join(kth, "item", "left")
            .withColumn("least", F.coalesce("least", F.lit(1).cast("long"))).where("bound >= least"))
    return ranked(first.drop("rank").unionByName(visit(index, rest, items, k)), k)


def search(docs: DataFrame, items: DataFrame, ws: Workspace, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, **sizes: int) -> DataFrame:
    """Each item's ``k`` documents of the highest score above 0: ``item_id``, ``rank``,
    ``doc_id``, ``score``; equal scores by id. ``sizes``: ``first_segments``, ``segment_docs``."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    size = asked.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    home = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        block = [(r["item_id"], r["text"]) for r in asked.where(home == b).collect()]
        if not block:
            continue
        found = search_block(docs, block, ws, f"block-{b}", k, id_col, text_col, **sizes)
        ids = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], "item int, item_id long")
        part = found.join(ids, "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("ord") != NO_ID, F.col("ord")).alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
total AS (SELECT count(*) AS n, sum(len(t)) AS l FROM words WHERE len(t) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM words)
       WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
m AS (SELECT doc_id, 75 + (25 * len(t) * n) // l AS m FROM words, total),
score AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
WHERE rank <= 20
"""


def brute_force(docs: list[tuple], items: list[tuple], k: int = K) -> list[tuple]:
    """The same rows by scoring every document for every item, for small tables."""
    import re

    def terms(text):
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]+", lambda x: x[0].lower(), text or ""))

    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        got = []
        for i, c in own:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                got.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(got)[:k])]
    return out
