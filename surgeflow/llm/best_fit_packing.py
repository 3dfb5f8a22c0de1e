"""Best-fit packing of documents into sequences by exact complements.

A document is its token ids and the id 0 behind them. One longer than a sequence is
cut into pieces of a whole sequence each, but for the first, which has what is left
over. The pieces are then placed in as few sequences as the method finds:

1. ``token_pieces`` encodes every whole text. Each task numbers its pieces of one
   length, so that a piece's place among all of its length is known without a sort:
   the pieces of that length in the tasks before, and its number (``in_length``).
2. Only the number of pieces of each length decides the packing: at most
   ``capacity`` numbers, whatever the corpus. ``plan`` begins sequences with the
   longest pieces left and fills their gaps exactly with one length, a sum of two or
   a sum of three that are in stock, looked up by the sum they must have; a gap that
   finds none takes its best fit, and what remains of it is looked up again. Each
   combination is used as often as its scarcest length lasts.
3. ``place`` looks up every piece's sequence and offset: a plan's row says from which
   number on the pieces of a length go to which sequences.

Null texts count as empty, which is the single id 0. Rows keep their multiplicity;
rows of one id, or of none, are documents of their own. The ids are those of the
``tokenizers`` library. Texts of usual characters, which every matcher of the
vocabulary's pattern classes alike, are encoded by ``tiktoken`` from the same
vocabulary, several times faster; any other text, and one that spells a special
token, by the library itself.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgeflow.llm.common import Workspace, whole_text

CAPACITY = 2048
END_ID = b"\0\0\0\0"
CHUNK_CHARS = 1 << 20

# characters that every matcher of the vocabulary's pattern classes alike
USUAL = "A-Za-zªµºÀ-ÖØ-öø-ɏ" "0-9" "!-/:-@[-`{-~¡-©«¬®-±´¶-¸»¿×÷–—‘’‚“”„†‡•…‰‹›€™" " \t\n\x0b\x0c\r"
UNUSUAL = re.compile(f"[^{USUAL}]")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: of byte-level vocabularies
CUT = re.compile(r" (?=\S)")  # no match of the pattern goes on over such a blank


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones
    for themselves, the others, in their order, for 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, kept by each Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        """The vocabulary's merges as ranks, if its ids are in the order of its merges
        and nothing but the pattern stands before them; else None."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, first = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"].get("".join(m)) for m in merges]
        plain = (spec["normalizer"] is None and first.get("type") == "ByteLevel" and first.get("use_regex", True)
                 and not first.get("add_prefix_space") and not any(model.get(k) for k in (
                     "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain or ids != sorted(set(ids)):
            return None
        byte = _bytes_of_symbols()
        ranks = {bytes(byte[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in self.special}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.fast or UNUSUAL.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        out, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + CHUNK_CHARS)
            stop = cut.start() if cut else len(text)
            out.append(np.array(self.fast.encode_ordinary(text[at:stop]), "<u4").tobytes())
            at = stop
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: the id, ``rid`` (the document's row), ``piece``, ``start``,
    ``length``, ``part`` and ``turn`` (its number among the pieces of its length in
    that part), ``ids`` (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, held = [], 0
            for i, text in enumerate(batch.column(2)):
                ids = encode(text.as_py()) + END_ID
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    rows.append((i, piece, start, length, int(seen[length]), ids[4 * start:4 * (start + length)]))
                    seen[length] += 1
                held += len(ids)
                if held > 4 * CHUNK_CHARS:
                    yield _pieces(batch, rows, part)
                    rows, held = [], 0
            if rows:
                yield _pieces(batch, rows, part)

    src = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("rid"), whole_text(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"_id {kind}, rid long, piece int, start long, length long, turn long, part int, ids binary")
    return out.withColumnRenamed("_id", id_col)


def _pieces(batch: pa.RecordBatch, rows: list[tuple], part: int) -> pa.RecordBatch:
    at, piece, start, length, turn, ids = zip(*rows)
    at = pa.array(at, pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(1).take(at), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
         pa.array(length, pa.int64()), pa.array(turn, pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array(ids, pa.binary())],
        names=["_id", "rid", "piece", "start", "length", "turn", "part", "ids"])


class Stock:
    """Pieces left of each length, and how many pairs of lengths in stock have each sum.

    A pair of one length needs two pieces of it. A length that runs out takes its
    pairs with it, one addition over all lengths; sums index both tables directly.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.pairs = np.zeros(2 * capacity + 1, np.int64)
        for x in np.flatnonzero(self.left):
            others = np.flatnonzero(self.left[:x])
            self.pairs[others + x] += 1
            self.pairs[2 * x] += self.left[x] > 1

    def take(self, length: int, n: int) -> None:
        before, now = self.left[length], self.left[length] - n
        if before > 1 and now < 2:
            self.pairs[2 * length] -= 1
        if now == 0:
            others = np.flatnonzero(self.left)
            self.pairs[others[others != length] + length] -= 1
        self.left[length] = now

    def _pair(self, total: int, without: dict[int, int]) -> tuple[int, int] | None:
        """The two lengths of that sum, the larger as large as can be."""
        left = self.left
        if without:
            left = left.copy()
            for x, n in without.items():
                left[x] -= n
        a = np.arange(max(1, total - len(left) + 1), total // 2 + 1)
        ok = (left[a] > 0) & (left[total - a] > 0) & ((2 * a != total) | (left[a] > 1))
        return (int(total - a[ok.argmax()]), int(a[ok.argmax()])) if ok.any() else None

    def complement(self, used: dict[int, int], gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths in stock, beside those ``used``, that fill ``gap`` exactly."""
        if self.left[gap] > used.get(gap, 0):
            return (gap,)
        if self.pairs[gap] and (pair := self._pair(gap, used)):
            return pair
        c = np.flatnonzero(self.left[:gap] > 0)
        for x in c[self.pairs[gap - c] > 0][::-1].tolist():
            more = used | {x: used.get(x, 0) + 1}
            if self.left[x] >= more[x] and (pair := self._pair(gap - x, more)):
                return (x, *pair)
        return None

    def longest(self, used: dict[int, int], room: int) -> int:
        """The longest in stock, beside those ``used``, that fits; 0: none."""
        fits = self.left[:room + 1].copy()
        for x, n in used.items():
            if x <= room:
                fits[x] -= n
        at = np.flatnonzero(fits > 0)
        return int(at[-1]) if len(at) else 0


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences by kind: (how many, [(length, times), ...]).

    The longest piece left begins a sequence. Its gap is filled exactly where one, two
    or three lengths do so; else the best fit, the longest piece that the gap takes,
    goes in, and the gap that remains is tried again. A kind is repeated as often as
    its scarcest length lasts, so that the kinds are of the order of the lengths."""
    stock, out = Stock(counts, capacity), []
    for length in range(capacity, 0, -1):
        while stock.left[length]:
            used, gap = {length: 1}, capacity - length
            while gap:
                fill = stock.complement(used, gap)
                for x in fill or (stock.longest(used, gap),):
                    if x:
                        used[x] = used.get(x, 0) + 1
                        gap -= x
                if not (fill or x):
                    break
            n = min(int(stock.left[x]) // t for x, t in used.items())
            for x, t in used.items():
                stock.take(x, n * t)
            out.append((n, sorted(used.items(), reverse=True)))
    return out


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, number of its first piece, pieces per sequence, first sequence,
    offset) by length and number."""
    next_, rows, sequence = dict.fromkeys(counts, 0), [], 0
    for n, slots in patterns(counts, capacity):
        offset = 0
        for length, times in slots:
            rows.append((length, next_[length], times, sequence, offset))
            next_[length] += n * times
            offset += length * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


RANK_BITS = 48


def in_length(pieces: DataFrame) -> DataFrame:
    """``pieces`` (a stored table) with ``number``: the place among all of that length."""
    held = pieces.groupBy("part", "length").agg((F.max("turn") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = held.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    return pieces.join(base, ["part", "length"]).withColumn("number", F.col("before") + F.col("turn")).drop("before", "turn", "part")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table of ``token_pieces``, with or without ids) with
    ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    rows = plan(counts, capacity)
    keys = rows[:, 0] << RANK_BITS | rows[:, 1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            at = np.searchsorted(keys, length << RANK_BITS | number, "right") - 1
            _, first, times, sequence, offset = rows[at].T
            turn = number - first
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sequence + turn // times), pa.array(offset + turn % times * length)],
                names=[*b.schema.names[:-1], "sequence_id", "offset"])

    numbered = in_length(pieces)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields[:-1])
    return numbered.mapInArrow(look_up, f"{shape}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, ws: Workspace, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Pieces and their places; ``ids`` (binary) or, without ``keep_ids``, ``ids_crc32`` alone."""
    pieces = token_pieces(docs, vocabulary, capacity, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    return place(ws.write(pieces if keep_ids else pieces.drop("ids"), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, of pieces with their ids: ``sequence_id``, ``n_tokens``, ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence's pieces: its capacity at most
    whole = F.aggregate(parts, F.lit(b""), lambda x, p: F.concat(x, p["ids"]))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), whole.alias("ids")))


def digest(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return packed.select(F.col(id_col).alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
