"""Token counts by a linear longest-match automaton.

Greedy word-piece splitting takes, at every place of a word, the longest piece
of the vocabulary: initial pieces at the word's start, inner ones behind. The
automaton is a trie over the bytes of either kind; a node from which a byte
leads nowhere has a failure link to the node where the greedy split goes on, and
the number of pieces that are then settled ("popped") is precomputed. A word is
read once, byte by byte, and its length in pieces is the sum of the pops:
no piece is ever built. For a vocabulary's bounded size the links are folded
into one table of (next node, pops) per node and byte, and all words of a chunk
take their steps together.

Words are runs of ``[^\\x20\\x09-\\x0D]`` bytes. A word that cannot be split
counts as one unknown token. Null and empty texts have no words; rows keep their
multiplicity; columns other than id and text are not read. Work is per document
in chunks of ``CHUNK_BYTES``; a word of any length is read whole.
"""

from __future__ import annotations

import base64
import functools
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgeflow.llm import repeats as R
from surgeflow.llm.common import whole_text
from surgeflow.llm.ngram_join import BLANK

CHUNK_BYTES = 1 << 20
LONG_WORD = 256  # bytes from which a word steps on its own
SPACE = 32


class Automaton:
    """Trie of initial and inner pieces with failure links and popped counts."""

    def __init__(self, initial: Iterable[bytes], inner: Iterable[bytes]):
        self.child: list[dict[int, int]] = [{}, {}]  # 0: a word's start, 1: behind a piece
        piece = {0: False, 1: False}
        for root, words in ((0, initial), (1, inner)):
            for w in words:
                v = root
                for b in w:
                    u = self.child[v].get(b)
                    if u is None:
                        u = self.child[v][b] = len(self.child)
                        self.child.append({})
                    v = u
                if v > 1:
                    piece[v] = True
        n = len(self.child)
        self.dead = n
        self.fail, self.pops = [-1] * n, [0] * n
        order, queue = [0, 1], deque([0, 1])
        while queue:  # level by level: a link leads to a shorter string
            u = queue.popleft()
            for b, v in self.child[u].items():
                queue.append(v)
                order.append(v)
                if piece.get(v):
                    self.fail[v], self.pops[v] = 1, 1
                    continue
                z, k = self.fail[u], self.pops[u]
                while z >= 0 and b not in self.child[z]:
                    k += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.child[z][b], k
        self.next = np.full((n + 1, 256), self.dead, np.int32)
        self.step = np.zeros((n + 1, 256), np.uint8)
        self.end = np.zeros(n + 1, np.int32)  # pops at a word's end; -1: it cannot be split
        self.end[[0, self.dead]] = -1
        for v in order:
            f = self.fail[v]
            if f >= 0:
                self.next[v] = self.next[f]
                self.step[v] = np.where(self.next[f] == self.dead, 0, self.step[f] + self.pops[v])
                self.end[v] = -1 if self.end[f] < 0 else self.pops[v] + self.end[f]
            elif v > 1:
                self.end[v] = -1
            for b, u in self.child[v].items():
                self.next[v, b], self.step[v, b] = u, 0
        self.child = []
        self.flat_next, self.flat_step = self.next.ravel(), self.step.ravel()

    def lengths(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: int = 0) -> np.ndarray:
        """Pieces of each word (0: it cannot be split); ``first``: the node words begin at."""
        order = np.argsort(-sizes, kind="stable")
        state = np.full(len(starts), first, np.int64)
        total = np.zeros(len(starts), np.int64)
        at, left = starts[order], sizes[order]
        long = int(np.searchsorted(-left, -LONG_WORD, "left"))
        for i in range(long):
            v, k = first, 0
            for b in data[at[i]:at[i] + left[i]].tolist():
                k += int(self.step[v, b])
                v = int(self.next[v, b])
            state[i], total[i] = v, k
        live = len(left)
        for t in range(int(left[long]) if long < live else 0):
            live = int(np.searchsorted(-left, -t, "left"))  # words of more than t bytes
            cell = (state[long:live] << 8) | data[at[long:live] + t]
            total[long:live] += self.flat_step[cell]
            state[long:live] = self.flat_next[cell]
        end = self.end[state]
        out = np.empty(len(starts), np.int64)
        out[order] = np.where(end < 0, 0, total + end)
        return out


@functools.lru_cache(maxsize=2)
def ranked_vocabulary(path: str) -> tuple[Automaton, int]:
    """Automaton of a file of base64 byte strings, and the node a word begins at:
    pieces that begin with a blank stand at a word's start, the others behind."""
    with open(path, "rb") as f:
        pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    a = Automaton([p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "])
    return a, int(a.next[0, SPACE])


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of every word, and each text's first word (one more entry)."""
    inside = ~BLANK[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    before = cuts[cuts > 0] - 1
    stops[before] = inside[before]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1 - starts, np.searchsorted(starts, offsets)


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_words``, ``n_tokens`` (an unknown word is one) and ``n_unknown``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, first = ranked_vocabulary(vocabulary)
        for batch in batches:
            data, offsets = R.doc_bytes(batch.column(1))
            cols = [np.zeros(batch.num_rows, np.int64) for _ in range(3)]
            for a, b in R.runs_of(offsets, CHUNK_BYTES):
                part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                starts, sizes, words = words_of(part, off)
                n = automaton.lengths(part, starts, sizes, first)
                sums = [np.concatenate([[0], np.cumsum(v)]) for v in (np.ones(len(n), np.int64), np.maximum(n, 1), n == 0)]
                for c, s in zip(cols, sums):
                    c[a:b] = s[words[1:]] - s[words[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols)], names=["_id", "n_words", "n_tokens", "n_unknown"])

    src = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).cast("binary").alias("_body"))
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, n_words long, n_tokens long, n_unknown long").withColumnRenamed("_id", id_col)


def brute_force(word: bytes, initial: set[bytes], inner: set[bytes]) -> int:
    """Pieces of a word by trying the longest first; 0: it cannot be split."""
    at, n, known = 0, 0, initial
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in known), 0)
        if not size:
            return 0
        at, n, known = at + size, n + 1, inner
    return n
