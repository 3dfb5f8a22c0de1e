"""Lexical search, best-fit packing and the filter audit against brute force."""

import bisect
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surgeflow.llm import best_fit_packing as B
from surgeflow.llm import filter_audit as A
from surgeflow.llm import lexical_search as L
from surgeflow.llm.common import Workspace
from tests.llm.conftest import DOC_SCHEMA

BPE = public_tokenizers.path("byte_bpe_50k.json")
ITEM_SCHEMA = "item_id long, text string"


def ordered(rows):
    return sorted(rows, key=repr)


def items_for(rows, seed=3):
    rng = random.Random(seed)
    texts = [t for _, t, *_ in rows if t and len(t) > 40]
    items = [(i, " ".join(rng.choice(texts).split()[:rng.randint(1, 12)])) for i in range(12)]
    return [*items, (12, None), (13, ""), (14, "..."), (15, "zebra1 zebra1 ZEBRA1"), (15, "one two"), items[3], (16, "no-such-term é ÉÉ 東京")]


@pytest.mark.parametrize("sizes", [{}, {"segment_docs": 3, "first_segments": 1, "block_bytes": 300}])
def test_search_equals_brute_force(spark, ws, docs, rows, sizes):
    items = items_for(rows)
    got = L.search(docs, spark.createDataFrame(items, ITEM_SCHEMA), ws, k=5, **sizes)
    assert ordered(map(tuple, got.collect())) == ordered(L.brute_force([(r[0], r[1]) for r in rows], items, 5))


def test_search_ties_nulls_repeats_and_clashing_names(spark, ws, odd, nothing):
    items = spark.createDataFrame([(7, "alpha beta", "x"), (7, "alpha beta", "x"), (None, "gamma", "y")], "item_id long, text string, score string")
    want = L.brute_force([(r.doc_id, r.text) for r in odd.collect()], [(7, "alpha beta"), (None, "gamma")])
    assert ordered(map(tuple, L.search(odd, items, ws).collect())) == ordered(want) and want
    with Workspace(spark, "none") as none:
        assert L.search(nothing, items.select("item_id", "text"), none).collect() == []
    with Workspace(spark, "none") as none:
        assert L.search(odd, spark.createDataFrame([], ITEM_SCHEMA), none).collect() == []


def test_terms_of_long_texts_are_whole(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("aBcé19 .,_-\n東") for _ in range(5000)).encode()
    whole = [t for part in L.terms_of(text) for t in part]
    monkeypatch.setattr(L, "CHUNK_BYTES", 7)
    assert [t for part in L.terms_of(text) for t in part] == whole
    import re
    assert whole == [x.lower() for x in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text)]


def test_scores_beyond_exact_doubles():
    s = L.Segment.of(75, np.arange(3), np.array([0, 1, 2, 3]), np.zeros(3, np.int64), np.array([1, 2, 5]))
    weight = np.array([1 << 40], np.int64)
    want = [(1 << 40) * (10**9 * tf // (1000 * tf + 12 * 75)) for tf in (1, 2, 5)]
    assert s.scores(np.zeros(1, np.int64), weight, 1 << 62).tolist() == want


def odd_texts(seed=4):
    rng = random.Random(seed)
    alphabet = "ab cD  'st9é¿\n\t\x0b\x1c\x85\xa0  　²½ªΩд東🙂.,-_<|"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [
        "<|endoftext|>", "a <|endoftext|> b", "don't we'll 'S", "  lead", "trail  ", " \n \n x", "x" * 5000, "é" * 300]


def test_ids_are_the_librarys(monkeypatch):
    library, encode = Tokenizer.from_file(BPE), B.Encoder(BPE)
    monkeypatch.setattr(B, "CHUNK_CHARS", 9)
    assert encode.fast
    for t in odd_texts():
        assert np.frombuffer(encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def best_fit(counts, capacity):
    """Sequences of best fit, longest first, piece by piece."""
    rooms, n = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            i = bisect.bisect_left(rooms, length)
            n += i == len(rooms)
            left = (capacity if i == len(rooms) else rooms.pop(i)) - length
            if left:
                bisect.insort(rooms, left)
    return n


@pytest.mark.parametrize("capacity", [1, 2, 7, 40, 300])
def test_plan_places_every_piece_once(capacity):
    rng = random.Random(capacity)
    for _ in range(30):
        counts = {n: rng.choice([1, 1, 2, 3, 9, 100]) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
        used, sequences = {}, 0
        for n, slots in B.patterns(counts, capacity):
            assert n > 0 and sum(size * times for size, times in slots) <= capacity
            sequences += n
            for size, times in slots:
                used[size] = used.get(size, 0) + n * times
        assert used == counts
        assert sequences <= best_fit(counts, capacity) * 1.01 + 1


def test_exact_complements_fill_sequences():
    """Lengths that come as complements of one, two and three others leave no room."""
    counts = {90: 5, 10: 5, 70: 4, 23: 4, 7: 4, 60: 3, 21: 3, 13: 3, 6: 3, 50: 8}
    kinds = B.patterns(counts, 100)
    assert all(sum(size * times for size, times in slots) == 100 for _, slots in kinds)
    assert sum(n for n, _ in kinds) == 16


def packed_by_hand(rows, capacity):
    library = Tokenizer.from_file(BPE)
    out = []
    for i, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out += [(i, p, s, n, zlib.crc32(ids[s:s + n].tobytes())) for p, (s, n) in enumerate(B.cuts(len(ids), capacity))]
    return out


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packed_sequences(spark, ws, docs, rows, capacity):
    packed = ws.write(B.pack(docs, BPE, ws, capacity), "packed")
    got = B.digest(packed).collect()
    assert ordered(tuple(r)[:5] for r in got) == ordered(packed_by_hand([(r[0], r[1]) for r in rows], capacity))
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids_crc32))
    whole = {r.sequence_id: (r.n_tokens, bytes(r.ids)) for r in B.sequences(packed).collect()}
    assert set(whole) == set(by)
    for s, parts in by.items():
        at = 0
        for offset, length, crc in sorted(parts):
            assert offset == at and zlib.crc32(whole[s][1][4 * at:4 * (at + length)]) == crc
            at += length
        assert at == whole[s][0] <= capacity and len(whole[s][1]) == 4 * at
    assert len(by) <= -(-sum(r.length for r in got) // capacity) * 1.05 + 1


def test_packing_nulls_repeats_and_clashing_names(spark, ws, odd, nothing):
    clash = odd.withColumn("part", F.lit("?")).withColumn("turn", F.lit("?")).withColumn("length", F.lit("?"))
    got = B.digest(B.pack(clash, BPE, ws, keep_ids=False)).collect()
    assert ordered(tuple(r)[:5] for r in got) == ordered(packed_by_hand([(r.doc_id, r.text) for r in odd.collect()], 2048))
    assert {r.sequence_id for r in got} == {0} and sorted(r.offset for r in got)[0] == 0
    with Workspace(spark, "none") as none:
        assert B.digest(B.pack(nothing, BPE, none)).collect() == []


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows_of(rng):
    words = ["".join(p) for p in itertools.product("abcde", repeat=3)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 199, 200, 260)]
    texts += [" ".join(["aaa", "bbb"] * 120), "A" * 3 + " x" * 250, texts[2] + " #", texts[3].upper(), None, "", "$", "A", "Aa" + "é" * 98]
    return [(rng.choice([None, *range(40)]), rng.choice(texts), "en", rng.choice(["s", "s", "t", "", None]), 0) for _ in range(90)]


@pytest.mark.parametrize("order", ["up", "down"])
def test_audit_equals_brute_force(spark, ws, tmp_path, order):
    """Whatever comes first: files of rising ids, or of falling ids (retractions)."""
    rng = random.Random(6)
    rows = audit_rows_of(rng)
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 40, 2)] + [(3, 0, 0), (3, 1, None), (None, 1, 1)]
    path = str(tmp_path / "documents.parquet")
    rows.sort(key=lambda r: (A.NO_ID if r[0] is None else r[0]) * (1 if order == "up" else -1))
    for k in range(5):  # the source takes files in the order they came
        spark.createDataFrame(rows[k::5] if order == "mixed" else rows[k * 18:(k + 1) * 18], DOC_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    df = A.audit(spark, path, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), ws, micro_batches=5)
    got = [tuple(r) for r in df.select(*AUDIT).collect()]
    assert ordered(got) == ordered(A.brute_force([(r[0], r[1], r[3]) for r in rows], labels))
    changes = spark.read.parquet(f"{ws.root}/stream/changes")
    assert (changes.where("n < 0").count() > 0) == (order == "down")


def test_audit_goes_on_with_new_files(spark, ws, tmp_path):
    """A second run over the same checkpoint takes only what came since, and retracts."""
    path, labels = str(tmp_path / "documents.parquet"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = audit_rows_of(random.Random(9))
    rows.sort(key=lambda r: -(r[0] or 0))
    for part in (rows[:50], rows[50:]):
        spark.createDataFrame(part, DOC_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        counters = A.part_counters(spark, path, labels, f"{ws.root}/s", 1, 16)
    got = [tuple(r) for r in A.audit_rows(counters).select(*AUDIT).collect()]
    assert ordered(got) == ordered(A.brute_force([(r[0], r[1], r[3]) for r in rows], []))


def test_audit_of_one_file_clashing_names_and_nothing(spark, odd, nothing, tmp_path):
    path = str(tmp_path / "odd.parquet")
    odd.withColumn("class", F.lit("?")).withColumn("id", F.lit("?")).withColumn("part", F.lit("?")).coalesce(1).write.parquet(path)
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    for at in (path, next(str(p) for p in (tmp_path / "odd.parquet").glob("*.parquet"))):
        with Workspace(spark, "odd") as ws:
            got = [tuple(r) for r in A.audit(spark, at, labels, ws).select(*AUDIT).collect()]
        want = A.brute_force([(r.doc_id, r.text, r.source) for r in odd.collect()], [(1, 1, 1)])
        assert ordered(got) == ordered(want)
    nothing.coalesce(1).write.parquet(str(tmp_path / "none.parquet"))
    with Workspace(spark, "none") as ws:
        assert A.audit(spark, str(tmp_path / "none.parquet"), labels, ws).collect() == []


def test_words_of_long_texts_are_whole(monkeypatch):
    rng = random.Random(3)
    body = "".join(rng.choice("ab \n\x0bé\x85\x1c") for _ in range(4000)).encode()
    whole = A._word_counts(body)
    monkeypatch.setattr(A, "CHUNK_BYTES", 11)
    assert A._word_counts(body) == whole
