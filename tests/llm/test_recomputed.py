"""Quality features and Hilbert cells recomputed one by one, in plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeflow.llm import hilbert_sharding as H
from surgeflow.llm import quality_gam as Q
from surgeflow.llm.common import Workspace


def features_of(text: str) -> list[float]:
    b = (text or "").encode()
    n = len(b)
    words = re.findall(rb"[^\x20\x09-\x0d]+", b)
    lowered = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]

    def share(pattern, of=None):
        return len(re.findall(pattern, b)) / max(n if of is None else of, 1)

    letters = len(re.findall(rb"[A-Za-z\x80-\xff]", b))
    lines, m = b.split(b"\n"), len(words)
    counts = Counter(lowered)
    return [math.log1p(n), math.log1p(m), len(b"".join(words)) / max(m, 1), share(rb"[A-Z]", letters), share(rb"[0-9]"),
            share(rb"[ \t\x0b\x0c\r]"), share(rb"\n"), share(rb"[.,;:'\"\-?()]"),
            share(rb"[\x00-\x08\x0e-\x1f!#-&*+/<->@\[-`{-\x7f]"), share(rb"[\x80-\xff]"),
            len(counts) / m if m else 0, max(counts.values(), default=0) / m if m else 0,
            sum(x == y for x, y in zip(lowered, lowered[1:])) / m if m else 0,
            len(set(lines)) / len(lines), math.log1p(n / len(lines)), b.count(b"!") / max(m, 1)]


def test_features_one_by_one(rows, monkeypatch):
    texts = [t or "" for _, t, *_ in rows] + ["a\nb\nb\n\n", "!!! Wow! wow WOW wow", "\t \x0b\r\n", "1, 2; (3) \"x\"-y? #$%&*+/<=>@[]^_`{|}~\x00\x7f"]
    body = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(body), np.uint8), np.cumsum([0, *map(len, body)])
    want = np.array([features_of(t) for t in texts])
    for chunk in (1 << 20, 300):  # texts together and one by one
        monkeypatch.setattr(Q, "CHUNK_BYTES", chunk)
        got = Q.features(data, offsets)
        for i, name in enumerate(Q.NAMES):
            assert np.allclose(got[:, i], want[:, i]), (name, [texts[j] for j in np.flatnonzero(~np.isclose(got[:, i], want[:, i]))][:2])


def test_scores_add_one_entry_per_table():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 3))
    m = Q.Model(0.3, [np.array([-0.5, 0.5])] * 3, [rng.normal(size=3) for _ in range(3)], [np.array([0, 0, 1])] * 3,
                [(0, 2, rng.normal(size=(2, 2)))])
    for row, s in zip(x, m.score(x)):
        b = [sum(v >= e for e in (-0.5, 0.5)) for v in row]
        total = 0.3 + sum(m.tables[i][b[i]] for i in range(3)) + m.pairs[0][2][int(b[0] == 2)][int(b[2] == 2)]
        assert math.isclose(s, 1 / (1 + math.exp(-total)))


def by_hand(rows, shards, bits=8):
    """(doc_id, size, crc, shard, slot, cell) with every dimension quantised here."""
    sizes = [len((t or "").encode()) + 1 for _, t, *_ in rows]
    top = max(1.0, math.log2(max(sizes)))

    def places(values):
        order = sorted(set(values), key=lambda v: (v is None, (v or "").encode()))
        return {v: i * (1 << bits) // len(order) for i, v in enumerate(order)}

    langs, sources = places([r[2] for r in rows]), places([r[3] for r in rows])
    out = []
    for r, size in zip(rows, sizes):
        cell = [[math.floor(math.log2(size) / top * ((1 << bits) - 1)), langs[r[2]], sources[r[3]]]]
        out.append((int(H.curve_index(np.array(cell), bits)[0]), (r[0] is not None, r[0] or 0), zlib.crc32((r[1] or "").encode()), r[0], size))
    out.sort(key=lambda x: x[:3])
    n = len(out)
    first = {}
    got = []
    for k, (cell, _, crc, i, size) in enumerate(out):
        shard = k * shards // n
        got.append((i, size, crc, shard, k - first.setdefault(shard, k), cell))
    return got


@pytest.mark.parametrize("shards", [1, 16, 500])
def test_cells_shards_and_slots_one_by_one(ws, docs, rows, shards):
    got = H.digest(H.cut_runs(H.hilbert_order(docs, ws), shards)).select("doc_id", "size", "text_crc32", "shard", "slot", "cell")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(by_hand(rows, shards), key=repr)


def test_cells_of_odd_rows(spark, odd):
    with Workspace(spark, "odd") as ws:
        got = H.digest(H.cut_runs(H.hilbert_order(odd, ws), 2)).select("doc_id", "size", "text_crc32", "shard", "slot", "cell")
        rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(by_hand(rows, 2), key=repr)
        assert got.agg(F.count(F.lit(1))).first()[0] == len(rows)
