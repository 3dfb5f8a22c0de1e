"""Fingerprints, SentencePiece, licence scan and quality scores."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from surgeflow.llm import fingerprint as FP
from surgeflow.llm import license_scan as L
from surgeflow.llm import quality_gam as Q
from surgeflow.llm import sentencepiece_codec as C

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# SentencePiece

def test_encoding_is_the_librarys(docs, rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = {r.doc_id: r for r in C.sentencepiece_codec(docs, MODEL).collect()}
    dig = {r.doc_id: r for r in C.digest(C.sentencepiece_codec(docs, MODEL)).collect()}
    for d, text, *_ in rows:
        ids = sp.encode(text or "")
        assert list(out[d].ids) == ids and out[d].decoded == sp.decode(ids)
        assert dig[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert dig[d].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert dig[d].n_tokens == len(ids)


def test_pieces_project_to_source_bytes():
    c, rng = C.codec(MODEL), random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(" \n\t▁aéÅ😀x.\0ab\r") for _ in range(rng.randint(0, 30)))
        ids = np.array(c.encode([text])[0], np.int64)
        assert ids.tolist() == c.sp.encode(text)
        starts, ends = c.spans(text, ids)
        src = text.encode()
        for k, (a, b) in enumerate(zip(starts, ends)):
            piece = c.sp.id_to_piece(int(ids[k]))
            want = bytes([int(piece[1:-1], 16)]) if c.sp.is_byte(int(ids[k])) else piece.replace("▁", " ").encode()
            got = src[a:b].replace("▁".encode(), b" ")
            assert got == want or (k == 0 and got == want[1:])
        assert not len(ids) or (starts[0] == 0 and ends[-1] == len(src) and (starts[1:] == ends[:-1]).all())


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nfkc_cf"])
def test_compiled_character_maps(rule):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(C.proto_fields(dict(C.proto_fields(lib.serialized_model_proto()))[3]))
    own, rng = C.Normalizer(spec), random.Random(3)
    texts = ["ﬁx Ⅳ  ｱ", "①a　b", " lead  trail  ", "", "   ", "ÀB̧ｶﾞ"]
    texts += ["".join(rng.choice(" \n▁aé①😀xｱﾞﬁ　­") for _ in range(rng.randint(0, 25))) for _ in range(300)]
    for t in texts:
        got, at = own(t)
        assert got.decode() == lib.normalize(t)
        assert len(at) == len(got) + 1 and (np.diff(at) >= 0).all()


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nfkc_cf"])
def test_models_with_a_character_map(rule, tmp_path):
    """The registered vocabulary under other normalisers: the ids come from the bytes
    that the own normaliser made, and are those of the library."""
    spec = dict(C.proto_fields(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()))[3]
    size, head = len(spec), b""
    while size > 127:
        head, size = head + bytes([size & 127 | 128]), size >> 7
    path = str(tmp_path / "m.model")
    with open(MODEL, "rb") as f, open(path, "wb") as g:
        g.write(f.read() + b"\x1a" + head + bytes([size]) + spec)
    lib, own, rng = sentencepiece.SentencePieceProcessor(model_file=path), C.Codec(path), random.Random(7)
    assert rule == "identity" or own.normalizer.charmap
    texts = ["ﬁx Ⅳ  ｱ", "①a　b", " lead  trail  ", "", "   ", "ÀB̧ｶﾞ", "▁x ▁"]
    texts += ["".join(rng.choice(" \n▁aébc the①😀xｱﾞﬁ　") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for t in texts:
        ids = own.encode([t])[0]
        assert ids == lib.encode(t), t
        starts, ends = own.spans(t, np.array(ids, np.int64))
        assert not ids or (starts[0] >= 0 and ends[-1] <= len(t.encode()) and (starts <= ends).all() and (np.diff(starts) >= 0).all())


def test_spans_hash_sees_every_span(docs):
    encoded = C.sentencepiece_codec(docs, MODEL)
    moved = encoded.withColumn("starts", F.transform("starts", lambda x, i: F.when(i == 0, x + 1).otherwise(x)))
    a, b = ({r.doc_id: r.spans_hash for r in C.digest(d).collect()} for d in (encoded, moved))
    filled = {r.doc_id for r in encoded.where("size(ids) > 0").collect()}
    assert filled and all((a[i] != b[i]) == (i in filled) for i in a)


def test_codec_odd_and_empty(odd, nothing):
    out = C.sentencepiece_codec(odd, MODEL).collect()
    assert len(out) == odd.count() and sum(len(r.ids) == 0 for r in out) == 3
    assert C.digest(C.sentencepiece_codec(nothing, MODEL)).collect() == []


# Fingerprints

def brute_fingerprints(pairs):
    order = sorted(pairs, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        e = t[:len(t) - k] + nxt[:k]
        a, b, c = (FP.digests([x.encode()]) for x in (t, e, nxt))
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), FP.spell(*a)[0], FP.spell(*b)[0],
                  float(FP.likeness(a, b)[0]), float(FP.likeness(a, c)[0]))
    return out


def test_fingerprints_match_brute_force(docs, rows, ws):
    got = {r.doc_id: tuple(r)[1:] for r in FP.fingerprints(docs, ws).collect()}
    assert got == brute_fingerprints([(r[0], r[1]) for r in rows])


def test_digest_counts_triplets_one_by_one():
    text = b"abcdefgh"
    counts = np.zeros(FP.BUCKETS, int)
    padded = text + b"\0" * 4
    for p in range(len(text)):
        for salt, (i, j) in zip(FP.SALTS, FP.TRIPLETS):
            h = (padded[p] << 16 | padded[p + i] << 8 | padded[p + j]) + (salt << 24)
            h = h * FP.MULTIPLIER & 0xFFFFFFFF
            h = (h ^ h >> 15) * FP.MULTIPLIER & 0xFFFFFFFF
            counts[h >> 24] += 1
    q = [sorted(counts)[FP.BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    codes, head = FP.digests([text])
    assert codes[0].tolist() == [sum(c > x for x in q) for c in counts]
    back = FP.parse(FP.spell(codes, head)[0])
    assert (back[0] == codes).all() and (back[1] == head).all()


def test_likeness_is_bounded_and_falls_with_edits():
    rng = random.Random(8)
    t = " ".join(str(rng.random()) for _ in range(200))
    one = FP.digests([t.encode()])
    near = [float(FP.likeness(one, FP.digests([(t[:len(t) - k] + "lorem ipsum " * (k // 12)).encode()]))[0]) for k in (0, 300, 1500)]
    assert near[0] == 1.0 and near[0] > near[1] > near[2] >= 0


def test_fingerprints_odd_and_empty(odd, nothing, spark):
    from surgeflow.llm.common import Workspace
    with Workspace(spark, "t") as a, Workspace(spark, "t") as b, Workspace(spark, "t") as c:
        got = FP.fingerprints(odd, a).collect()
        assert len(got) == odd.count() and all(0 <= r.near_next <= 1 for r in got)
        assert len({r.fingerprint for r in got if r.n_chars == 16}) == 1
        assert FP.fingerprints(nothing, b).collect() == []
        (r,) = FP.fingerprints(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), c).collect()
        assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"aba").hexdigest()  # it follows itself


# Licences

COMPILED = [(r, re.compile(L.bounded(r.pattern))) for r in L.rules()]


def brute_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = " " + " ".join(w) + " "
    hits = [(s[:m.start()].count(" ") - 1, s[:m.start()].count(" ") + m[0].count(" "), r)
            for r, c in COMPILED for m in c.finditer(s)]

    def rank(h):
        return h[0], -h[1], -h[2].priority, h[2].number

    kept = [h for h in hits if h[2].base or not any(
        g[0] <= h[0] and g[1] >= h[1] and g[2].priority >= h[2].priority and rank(g) < rank(h) for g in hits)]
    base = [h for h in hits if h[2].base]
    return (len(w), len(base), min((h[0] for h in base), default=None), max((h[0] for h in base), default=None),
            ",".join(sorted({h[2].label for h in base})), ",".join(sorted({h[2].label for h in kept})),
            max((h[2].sure for h in kept), default=0.0))


def test_licence_scan_matches_brute_force(docs, rows, ws):
    got = {r.doc_id: tuple(r)[1:8] for r in L.digest(*L.scan_licences(docs, ws)).collect()}
    want = {r[0]: brute_scan(r[1]) for r in rows}
    assert got == want and sum(bool(w[5]) for w in want.values()) == 5


LINES = ["Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-2.0-only",
         "see the GNU LESSER GENERAL PUBLIC LICENSE version 3", "https://creativecommons.org/licenses/by-nc/4.0/",
         "under the terms of the BSD 3-Clause license; under the MIT license and under the mit   license",
         "released under CC-BY-SA 4.0, cc by nc cc by nc nd", "This is free and unencumbered software released into the public domain",
         "licence: ISC. The zlib licence; Mozilla Public License 2.0; Boost Software License - Version 1.0"]


def test_rules_one_by_one(spark, ws):
    data = [(i, t) for i, t in enumerate(LINES)]
    got = {r.doc_id: tuple(r)[1:8] for r in L.digest(*L.scan_licences(spark.createDataFrame(data, "doc_id long, text string"), ws)).collect()}
    assert got == {i: brute_scan(t) for i, t in data}
    assert all(got[i][5] for i in got)
    assert got[0][5] == "apache-2" and got[1][5] == "gpl-2" and got[4][5] == "bsd-3-clause,mit"


def test_rules_are_hundreds_and_gated():
    found = L.rules()
    assert len(found) > 300 and len({r.pattern for r in found if not r.base}) > 280
    for t in LINES:  # whatever a rule finds, its keys and the gate let pass
        low = t.lower()
        s = " " + " ".join(re.findall(r"[0-9a-z]+", low)) + " "
        for r, c in COMPILED:
            if c.search(s):
                assert any(k in s for k in r.keys), r
                assert any(g in low for g in L.GATE) or re.search(L.GATE_PATTERN, low), r


def samples(pattern):
    """A few texts that the pattern matches: every branch and option taken once at least."""
    def of(items):
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                some = [chr(arg)]
            elif name == "IN":
                some = [chr(arg[0][1] if str(arg[0][0]) == "LITERAL" else arg[0][1][0])]
            elif name == "ANY":
                some = ["x"]
            elif name == "SUBPATTERN":
                some = of(arg[-1])
            elif name == "BRANCH":
                some = [t for b in arg[1] for t in of(b)]
            elif name == "MAX_REPEAT":
                some = [""] * (arg[0] == 0) + of(arg[2])
            else:
                assert name in ("ASSERT", "ASSERT_NOT"), name
                some = [""]
            n = max(len(out), len(some))
            out = [out[i % len(out)] + some[i % len(some)] for i in range(n)]
        return out
    return of(re._parser.parse(pattern))


def test_every_rule_passes_the_gate(spark, ws):
    texts = [(r, t) for r in L.rules() for t in samples(r.pattern)]
    found = [(r, t) for r, t in texts if re.search(L.bounded(r.pattern), f" {t} ")]
    assert {r.number for r, _ in found} == {r.number for r in L.rules()}
    lines = [t for _, t in found] + [f"See:{t.upper().replace(' ', ' -- ')}." for _, t in found]
    lines += ["Released under the MIT.", "Distributed under the BSD 3-Clause terms", "Released under MPL 2.0.", "see the Mozilla Public file",
              "https://www.mozilla.org/MPL/2.0/", "https://www.eclipse.org/legal/epl-v10.html", "http://www.wtfpl.net/",
              "https://scripts.sil.org/OFL", "https://joinup.ec.europa.eu/collection/xeupl"]
    data = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:8] for r in L.digest(*L.scan_licences(data, ws)).collect()}
    assert got == {i: brute_scan(t) for i, t in enumerate(lines)} and all(g[5] for g in got.values())


def test_licence_scan_odd_and_empty(odd, nothing, ws, spark):
    from surgeflow.llm.common import Workspace
    got = L.digest(*L.scan_licences(odd, ws)).collect()
    assert sorted(r.n_words for r in got) == [0, 0, 0, 3, 3, 3] and {r.labels for r in got} == {""}
    with Workspace(spark, "t") as other:
        assert L.digest(*L.scan_licences(nothing, other)).collect() == []


def test_licence_scan_runs_no_python(docs, ws):
    plan = L.digest(*L.scan_licences(docs, ws))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Quality

@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_held_out_accuracy(spark, sf):
    from __spark_entry__ import queries
    path = f"/root/testdata/sf{sf}"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = (queries()["op4_quality_gam"](spark, path).join(labels, "doc_id").where("held_out")
           .groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right"),
                                   F.count("*").alias("n")).collect())
    assert {r.quality for r in got} == {0, 1} and all(r.right > 0.95 for r in got), got


def test_held_out_rows_and_range(spark, docs, rows):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)] + [(None, 1), (4, None)], "doc_id long, quality int")
    out = {r.doc_id: r for r in Q.digest(docs, Q.train(docs, labels)).collect()}
    for d, *_ in rows:
        r = out[d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_labels_of_held_out_rows_are_not_read(spark, docs, rows):
    even = [(r[0], i % 2) for i, r in enumerate(rows)]
    flip = [(d, 1 - q if zlib.crc32(str(d).encode()) % 3 == 1 else q) for d, q in even]
    a, b = (Q.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (even, flip))
    assert a.base == b.base and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_scores_are_sums_of_table_entries(spark, docs, rows):
    rng = np.random.default_rng(1)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # nothing but an interaction
    m = Q.fit(x, y)
    assert ((m.score(x) >= 0.5) == y).mean() > 0.95 and (0, 1) in {tuple(sorted(p[:2])) for p in m.pairs}
    bins = m.bins(x)
    total = m.base + sum(t[b] for t, b in zip(m.tables, bins)) + sum(t[m.coarse[i][bins[i]], m.coarse[j][bins[j]]] for i, j, t in m.pairs)
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-np.clip(total, -30, 30))))


def test_quality_without_labels_and_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = Q.score(odd, Q.train(odd, none))
    assert sorted(out.columns) == sorted(odd.columns) and {r.score for r in out.collect()} == {0.5}
    assert Q.digest(nothing, Q.train(nothing, none)).collect() == []


def test_training_rows_are_bounded(spark, docs, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append(len(x)) or Q.Model())
    Q.train(docs, spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int"), rows=10)
    assert seen == [10]
