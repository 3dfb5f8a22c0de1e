"""Offset-preserving SentencePiece encoding and decoding.

A text is normalised as the model's own rules say: at each place the longest
prefix that the compiled character map knows is replaced, white space becomes
U+2581 and a dummy prefix is set before the text. The normaliser records for
every normalised byte which source byte it came from, so that each piece,
whose normalised length the vocabulary gives, projects to a byte span of the
original text. Pieces are those that the sentencepiece library, its own normaliser switched
off, gives for the normalised bytes, word by word: where
no piece of the vocabulary holds white space after another character, no merge
crosses a word's start and a word encodes alone as it does within its text.
Words repeat, so each worker keeps a bounded table of those it has seen. Other
vocabularies are encoded text by text.

Null texts count as empty (no pieces, decoded to ""); rows keep their
multiplicity; input columns other than the id and the text are not read, so
their names may clash with those of the result. A document is one row of one
task: work and memory follow the longest text, not a group.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_WORDS = 400_000  # entries of a worker's table; words beyond it are encoded whenever met
CHUNK_BYTES = 1 << 20


def proto_fields(b: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(field number, value) of one protobuf message."""
    i, n = 0, len(b)

    def varint() -> int:
        nonlocal i
        v = s = 0
        while True:
            c = b[i]
            i += 1
            v |= (c & 127) << s
            s += 7
            if c < 128:
                return v

    while i < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, b[i:i + size]
            i += size


def proto_bytes(field: int, body: bytes) -> bytes:
    """A field of a protobuf message that holds (up to 127) bytes."""
    return bytes([field << 3 | 2, len(body)]) + body


# a normaliser's rules that change nothing: name, empty map, no prefix, no squeezing, no escaping
AS_IS = proto_bytes(1, b"identity") + proto_bytes(2, b"") + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 0])


class CharMap:
    """A compiled character map: a double-array trie over source strings whose
    leaves are offsets of their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int, end: int) -> tuple[int, bytes] | None:
        """(source length, replacement) of the longest known prefix at ``at``."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, end):
            c = text[i]
            node ^= c
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != c:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1]:self.strings.index(b"\0", found[1])]


class Normalizer:
    """Normalised text and the source byte of each of its bytes."""

    def __init__(self, spec: dict):
        blob = spec.get(2, b"")
        self.charmap = CharMap(blob) if blob else None
        self.dummy_prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        src = text.encode()
        space = SPACE.encode() if self.escape else b" "
        if self.charmap is None and not self.squeeze:
            return self._identity(src, space)
        out, at = bytearray(), []
        i, n, blank, started = 0, len(src), self.squeeze, False
        while i < n:
            hit = self.charmap.longest(src, i, n) if self.charmap else None
            if hit:
                used, new = hit
            else:
                c = src[i]
                used = 1 if c < 128 else 2 if c < 224 else 3 if c < 240 else 4
                new = src[i:i + used]
            if self.squeeze and blank:
                new = new.lstrip(b" ")
            if new and not started:
                started = True
                if self.dummy_prefix:
                    out += space
                    at += [i] * len(space)
            if new:
                blank = new.endswith(b" ")
                new = new.replace(b" ", space)
                out += new
                at += [i] * len(new)
            i += used
        if self.squeeze:  # trailing white space goes; the last piece ends where its source does
            while out.endswith(space):
                del out[-len(space):]
                del at[-len(space):]
            while out and n > at[-1] + 1 and src[n - 1] == 32:
                n -= 1
        return bytes(out), np.array([*at, n], np.int64)

    def _identity(self, src: bytes, space: bytes) -> tuple[bytes, np.ndarray]:
        if not src:
            return b"", np.zeros(1, np.int64)
        a = np.frombuffer(src, np.uint8)
        width = np.where(a == 32, len(space), 1)
        at = np.repeat(np.arange(len(a)), width)
        out = src.replace(b" ", space)
        if self.dummy_prefix:
            out, at = space + out, np.concatenate([np.zeros(len(space), np.int64), at])
        return out, np.append(at, len(a))


class Codec:
    """Encoder and decoder of one model file, kept by each Python worker."""

    def __init__(self, model: str):
        import sentencepiece

        with open(model, "rb") as f:
            proto = f.read()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        # of a field that occurs again the parts are merged, the last of each holds
        self.normalizer = Normalizer({k: v for f, spec in proto_fields(proto) if f == 3 for k, v in proto_fields(spec)})
        # the library for text that is normalised already: no map, no prefix, white space as it is
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto + proto_bytes(3, AS_IS))
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        byte = [self.sp.is_byte(i) for i in range(n)]
        self.width = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, byte)], np.int64)
        words = [p for p, b in zip(pieces, byte) if not b]
        nz = self.normalizer
        self.by_word = (nz.charmap is None and not nz.squeeze and nz.dummy_prefix and nz.escape
                        and any(byte)  # an unknown character falls to bytes, never joins its neighbour
                        and SPACE in words and not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in words))
        self.known: dict[str, list[int]] = {SPACE: [self.sp.piece_to_id(SPACE)]}  # "" has no pieces at all

    def _words(self, segments: set[str]) -> dict[str, list[int]]:
        """Ids of segments: white space then a word, or a line break then a word."""
        new = [s for s in segments if s not in self.known]
        fresh = dict(zip(new, self.plain.encode(new, num_threads=1)))
        if len(self.known) + len(fresh) <= CACHE_WORDS:
            self.known |= fresh
            return self.known
        return fresh | {s: self.known[s] for s in segments if s in self.known}

    def pieces(self, normal: list[str]) -> list[list[int]]:
        """Ids of normalised texts."""
        if not self.by_word:
            return self.plain.encode(normal, num_threads=1)
        split = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*").findall
        segments = [split(t) for t in normal]
        known, out = self._words(set().union(*segments)), []
        for words in segments:
            ids: list[int] = []
            for w in words:
                ids += known[w]
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.pieces([self.normalizer(t)[0].decode() for t in texts])

    def project(self, normal: str, size: int, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end byte in the original of every piece of a normalised text of
        ``size`` bytes, whose source bytes are ``at``."""
        width = self.width[ids]
        if width.sum() != size:  # pieces that stand for unknown characters
            width = np.array([len(p.encode()) if self.sp.is_unknown(i) else self.width[i]
                              for p, i in zip(self.plain.encode(normal, out_type=str), ids.tolist())], np.int64)
        ends = np.cumsum(width)
        return at[ends - width], at[ends]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        normal, at = self.normalizer(text)
        return self.project(normal.decode(), len(normal), at, ids)


@functools.lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    return Codec(model)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def sentencepiece_codec(docs: DataFrame, model: str, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Per row: the id, ``ids`` (all piece ids), ``starts`` and ``ends`` (each
    piece's byte span in the original) and ``decoded`` (the library's decoding
    of the ids). ``model`` is a path every executor can open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                recorded = [c.normalizer(t) for t in texts[a:b]]
                normal = [n.decode() for n, _ in recorded]
                ids = c.pieces(normal)
                arrays = [np.array(x, np.int32) for x in ids]
                spans = [c.project(t, len(n), at, x) for t, (n, at), x in zip(normal, recorded, arrays)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), _lists(arrays), _lists([s for s, _ in spans]),
                     _lists([e for _, e in spans]), pa.array([c.sp.decode(x) for x in ids], pa.string())],
                    names=["_id", "ids", "starts", "ends", "decoded"])

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"_id {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string")
    return out.withColumnRenamed("_id", id_col)


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, SHA-256 digests of ids and decoded text, and a hash of all pieces' spans."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes_spanned"),
        F.xxhash64("starts", "ends").alias("spans_hash"))
