"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into quantile bins and has a lookup table of
log-odds, grown by cyclic boosting: round after round each feature in turn gets
one shallow tree (up to four leaves) on the current gradient, shrunk by
``RATE``, and the tree's leaves are added to its table. Then the pairs of
features whose coarse grid explains most of what is left get two-dimensional
tables in the same way. A score is the logistic of the sum of one entry per
table: scoring is bin look-ups and additions, and each table can be read.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (the smallest
hashes of their ids; a documented bound) whose features alone reach the driver;
every document is scored. Features are of the text only. Null and empty texts
score like any other, by the bins of an empty text. Without labels of both
kinds the score is the share of good ones, 0.5 without any. Rows whose label or
id is null are not learnt from; repeated rows count one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgeflow.llm import repeats as R
from surgeflow.llm.common import whole_text
from surgeflow.llm.ngram_join import word_hashes

TRAIN_ROWS = 20_000
BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 6
RATE, RIDGE, LEAF_ROWS = 0.1, 1.0, 5
CHUNK_BYTES = 1 << 20

CLASSES = 8  # lower, upper, digit, blank, line break, sentence mark, other symbol, beyond ASCII
CLASS = np.full(256, 6, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58] = 0, 1, 2
CLASS[[9, 11, 12, 13, 32]], CLASS[10] = 3, 4
CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 5
CLASS[128:] = 7
NAMES = ("log_bytes", "log_words", "word_length", "upper", "digit", "blank", "breaks", "marks", "symbols", "beyond",
         "distinct_words", "top_word", "echo", "distinct_lines", "line_length", "bang")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``NAMES`` per text."""
    out = np.zeros((len(offsets) - 1, len(NAMES)))
    for a, b in R.runs_of(offsets, CHUNK_BYTES):
        part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        n, size = b - a, np.diff(off)
        some = np.maximum(size, 1)
        doc = np.repeat(np.arange(n), size)
        kinds = np.bincount(doc * CLASSES + CLASS[part], minlength=n * CLASSES).reshape(n, CLASSES)
        bang = np.bincount(doc[part == 33], minlength=n)
        w, first = word_hashes(part, off)
        words = np.diff(first)
        f = out[a:b]
        f[:, 0], f[:, 1] = np.log1p(size), np.log1p(words)
        f[:, 2] = (size - kinds[:, 3] - kinds[:, 4]) / np.maximum(words, 1)
        letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 7], 1)
        f[:, 3] = kinds[:, 1] / letters
        for col, kind in ((4, 2), (5, 3), (6, 4), (7, 5), (8, 6), (9, 7)):
            f[:, col] = kinds[:, kind] / some
        f[:, 15] = bang / np.maximum(words, 1)
        same = np.concatenate([[False], w[1:] == w[:-1]]) if len(w) else np.zeros(0, bool)
        text = part.tobytes()
        for i in range(n):
            lo, hi = first[i], first[i + 1]
            if hi > lo:
                _, counts = np.unique(w[lo:hi], return_counts=True)
                f[i, 10], f[i, 11] = len(counts) / (hi - lo), counts.max() / (hi - lo)
                f[i, 12] = same[lo + 1:hi].sum() / (hi - lo)
            lines = text[off[i]:off[i + 1]].split(b"\n")
            f[i, 13], f[i, 14] = len(set(lines)) / len(lines), np.log1p(size[i] / len(lines))
    return out


@dataclass
class Model:
    """Bin edges and tables; ``pairs`` holds (feature, feature, table)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # each bin's coarse bin
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        b = self.bins(x)
        for table, at in zip(self.tables, b):
            total += table[at]
        for i, j, table in self.pairs:
            total += table[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram in two."""
    gl, hl, nl = (np.cumsum(v)[:-1] for v in (g, h, n))
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    gain[(nl < LEAF_ROWS) | (n.sum() - nl < LEAF_ROWS)] = -1
    if not len(gain):
        return -1.0, 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Leaf values, per bin, of a tree grown best cut first."""
    open_ = [(0, len(g))]
    while len(open_) < leaves:
        found = [(*_best_cut(g[a:b], h[a:b], n[a:b]), a, b) for a, b in open_]
        gain, at, a, b = max(found)
        if gain <= 0:
            break
        open_.remove((a, b))
        open_ += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in open_:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _grid(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut of a grid in four by one line on either axis: gain and values."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, cut = 0.0, None
    whole = _gain(gc[-1, -1], hc[-1, -1])
    for r in range(len(g) - 1):
        for c in range(g.shape[1] - 1):
            q = [(v[r, c], v[r, -1] - v[r, c], v[-1, c] - v[r, c], v[-1, -1] - v[r, -1] - v[-1, c] + v[r, c]) for v in (gc, hc)]
            gain = sum(_gain(x, y) for x, y in zip(*q)) - whole
            if gain > best:
                best, cut = gain, (r + 1, c + 1, q)
    out = np.zeros_like(g)
    if cut:
        r, c, (qg, qh) = cut
        v = [x / (y + RIDGE) for x, y in zip(qg, qh)]
        out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = v
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    m = Model()
    m.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    m.coarse = [np.arange(len(e) + 1) * COARSE // (len(e) + 1) for e in m.edges]
    good = float(y.sum())
    if good in (0.0, float(len(y))):
        share = (good + 0.5) / (len(y) + 1)
        m.base = float(np.log(share / (1 - share)))
        return m
    m.base = float(np.log(good / (len(y) - good)))
    bins, total = m.bins(x), np.full(len(y), m.base)
    count = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, m.tables)]

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, t, n in zip(bins, m.tables, count):
            if len(t) < 2:
                continue
            g, h = slope()
            step = RATE * _tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), n)
            t += step
            total += step[b]
    rough = [c[b] for c, b in zip(m.coarse, bins)]
    g, h = slope()

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(rough[i] * COARSE + rough[j], v, COARSE * COARSE).reshape(COARSE, COARSE)

    gains = [(_grid(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(x.shape[1]) for j in range(i)]
    m.pairs = [(i, j, np.zeros((COARSE, COARSE))) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in m.pairs:
            g, h = slope()
            step = RATE * _grid(grid(i, j, g), grid(i, j, h))[1]
            t += step
            total += step[rough[i], rough[j]]
    return m


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        f = features(*R.doc_bytes(b.column(1)))
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in f.T]], names=["good", *NAMES])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled rows that are not held out."""
    place = F.xxhash64(F.col(id_col).cast("string"))
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("good"), place.alias("_place")))
    total = known.count()
    if total > rows:  # drop most of the rest before ordering what may stay
        share = min(1.0, 1.2 * rows / total + 1000 / total)
        known = known.where(F.col("_place") < F.lit(int(-2**63 + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
        known = known.orderBy("_place", "_id", "good").limit(rows)
    # at most ``rows`` rows of an id and a label
    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).cast("binary").alias("_body")).join(
        F.broadcast(known.drop("_place")), "_id")
    # two documents may share a labelled id: their features still number about ``rows``
    got = chosen.select("good", "_body").mapInArrow(
        _measure, "good double, " + ", ".join(f"{n} double" for n in NAMES)).toPandas()
    got = got.sort_values(list(got.columns)).to_numpy()
    return fit(got[:, 1:], got[:, 0])


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a column of scores, the only one it replaces if the name clashes."""
    def run(batches: Iterator) -> Iterator:
        for texts in batches:
            data = pa.array(texts, pa.binary())
            yield _series(model.score(features(*R.doc_bytes(data))))

    import pandas as pd

    def _series(v: np.ndarray) -> pd.Series:
        return pd.Series(v)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(run, "double")
    return docs.withColumn(into, udf(whole_text(text_col).cast("binary")))


def digest(docs: DataFrame, model: Model) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
