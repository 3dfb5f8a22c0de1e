"""Mixing, sharding and nearest neighbours."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeflow.llm import hilbert_sharding as H
from surgeflow.llm import mixing as M
from surgeflow.llm import multiprobe_ann as A
from surgeflow.llm.common import Workspace, global_rank

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sizes(rows):
    return {r[0]: len(SPACE.findall(r[1] or "")) for r in rows}


def water(by_source, weights=(3.0, 1.0, 2.0), share=1.5, cap=2):
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = share * sum(by_source.values()), set()
    while True:
        rest = total - sum(cap * by_source[s] for s in full)
        left = sum(w[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * w[s] / left > cap * by_source[s]}
        if not over:
            return {s: cap * by_source[s] if s in full else rest * w[s] / left for s in names}
        full |= over


def test_mix_reaches_its_targets(docs, rows, ws):
    got = {r.doc_id: r for r in M.mix_sources(docs, ws).collect()}
    n, by_source, taken = sizes(rows), defaultdict(int), defaultdict(int)
    for r in rows:
        by_source[r[3]] += n[r[0]]
    want = water(by_source)
    for r in rows:
        g = got[r[0]]
        assert g.size == n[r[0]] and g.source_size == by_source[r[3]] and math.isclose(g.target, want[r[3]])
        assert 0 <= g.taken <= 2 * g.size
        taken[r[3]] += g.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_mix_reruns_agree(docs, spark):
    with Workspace(spark, "a") as a, Workspace(spark, "b") as b:
        x = sorted(map(tuple, M.mix_sources(docs, a).drop("rid").collect()))
        y = sorted(map(tuple, M.mix_sources(docs.repartition(5), b).drop("rid").collect()))
    assert x == y


def test_schedule_is_even_everywhere(spark, ws):
    sized = spark.createDataFrame([(s, n) for s, n in (("a", 9000), ("b", 50000), ("c", 20000), (None, 3))], "source string, size long")
    quotas = ws.write(M._quotas(M.source_targets(sized), 16), "q")
    slots = sorted(M.schedule(quotas, 16).collect(), key=lambda r: r.slot)
    share = {r.src: r.slots / sum(q.slots for q in quotas.collect()) for r in quotas.collect()}
    seen = Counter()
    for i, r in enumerate(slots, 1):
        seen[r.src] += 1
        assert all(abs(seen[s] - share[s] * i) <= 8 for s in share)  # low discrepancy in every stretch
    for q in quotas.collect():
        own = [r for r in slots if r.src == q.src]
        assert len(own) == q.slots and sum(r.words for r in own) == q.words
        assert [(r["pass"], r.block) for r in own] == [(k // q.blocks, k % q.blocks) for k in range(q.slots)]


def test_mix_odd_empty_and_native(odd, nothing, spark, docs):
    with Workspace(spark, "a") as a, Workspace(spark, "b") as b, Workspace(spark, "c") as c:
        got = M.mix_sources(odd, a).collect()
        assert len(got) == odd.count() and sum(r.size for r in got) == 9
        assert M.mix_sources(nothing, b).collect() == []
        assert not re.search("Python|Pandas|Arrow", M.mix_sources(docs, c)._jdf.queryExecution().toString())


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_steps_of_one(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = H.curve_index(cells, bits)
    order = np.argsort(index)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_shards_of_the_law_rows(docs, rows, ws, spark):
    out = H.digest(H.cut_runs(H.hilbert_order(docs, ws), 16)).collect()
    assert len(out) == len(rows)
    text = {r[0]: (r[1] or "").encode() for r in rows}
    counts = Counter(r.shard for r in out)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(16):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    for r in out:
        assert r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id])
        assert r.law == "rows" and r.grown_shard is None
    placed = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [(r.cell, r.doc_id) for r in placed] == sorted((r.cell, r.doc_id) for r in out)


def test_shards_reach_files_in_order(docs, rows, ws, spark, tmp_path):
    sharded = H.cut_runs(H.hilbert_order(docs, ws), 4)
    H.write_shards(docs, sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and set(docs.columns) < set(back.columns)


def test_equal_rows_reach_files_once_each(ws, spark, tmp_path):
    data = [(1, "alpha beta", "en", "s")] * 3 + [(1, "alpha beta", "fr", "s")] * 2 + [(None, "alpha", None, "t")] * 4
    data += [(None, None, "en", None)] * 2 + [(i, f"text {i}", "en", "s") for i in range(2, 12)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(path)
    some = spark.read.parquet(path)
    sharded = H.cut_runs(H.hilbert_order(some, ws), 4)
    H.write_shards(some, sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(tuple(r) for r in back.drop("shard").collect()) == Counter(data)
    assert ({r.shard: r["count"] for r in back.groupBy("shard").count().collect()}
            == {r.shard: r["count"] for r in sharded.groupBy("shard").count().collect()})


def test_shards_odd_and_empty(odd, nothing, spark):
    with Workspace(spark, "a") as a, Workspace(spark, "b") as b:
        out = H.digest(H.cut_runs(H.hilbert_order(odd, a), 16)).collect()
        assert len(out) == odd.count() and sum(r.size == 1 for r in out) == 3
        assert H.digest(H.cut_runs(H.hilbert_order(nothing, b), 16)).collect() == []


def test_global_rank_is_gapless(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(6)
    got = sorted((r["rank"], r.k, r.v) for r in global_rank(df, [F.col("k"), F.col("v").desc()]).collect())
    assert [g[0] for g in got] == list(range(500))
    assert [(g[1], -g[2]) for g in got] == sorted((g[1], -g[2]) for g in got)


def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, rank string")


def test_neighbours_recall_and_exact_scores(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    got = defaultdict(list)
    for r in A.nearest(spark.read.parquet(path), F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    table = {r.vec_id: r.embedding for r in spark.read.parquet(path).collect()}
    ids = np.array(sorted(table))
    x = np.array([table[i] for i in ids], float)
    recall = []
    for q in got:
        want, _ = A.brute_force(ids, x, q, np.array(table[q], float))
        rows = sorted(got[q])
        assert [r for r, _, _ in rows] == list(range(1, 21)) and q not in {v for _, v, _ in rows}
        assert all(abs(s - np.dot(np.array(table[v], float), np.array(table[q], float))) < 1e-12 for _, v, s in rows)
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        recall.append(len({v for _, v, _ in rows} & set(want.tolist())) / 20)
    assert len(got) == sum(i % 20 == 0 for i in table) and np.mean(recall) >= 0.9


@pytest.mark.parametrize("norms", ["lognormal", "one row 100x", "one row 1e6x", "tiny and huge"])
def test_neighbours_recall_with_uneven_norms(spark, norms):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2000, 64))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    if norms == "lognormal":
        x *= rng.lognormal(0, 1, (2000, 1))
    elif norms == "tiny and huge":
        x[::3] *= 1e-9
        x[1::3] *= 1e9
    else:
        x[7] *= 100 if norms == "one row 100x" else 1e6
    x = x.astype(np.float32).astype(float)
    got = defaultdict(list)
    for r in A.nearest(vectors(spark, [(i, v.tolist(), "") for i, v in enumerate(x)]), F.col("vec_id") % 20 == 0).collect():
        got[r.query_id].append(r.vec_id)
    recall = [len(set(got[q]) & set(A.brute_force(np.arange(2000), x, q, x[q])[0].tolist())) / 20 for q in range(0, 2000, 20)]
    assert {len(set(v)) for v in got.values()} == {20} and len(got) == 100
    assert np.mean(recall) >= 0.9, np.mean(recall)


def test_queries_whose_probes_miss_meet_all_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 64)
    h, rng = A.Hasher(32), np.random.default_rng(6)
    for _ in range(2000):  # 15 queries opposite to the 600 other rows, in a direction where their probes miss
        e = rng.standard_normal(32)
        e /= np.sqrt(e @ e)
        x = np.concatenate([np.tile(e, (600, 1)), np.tile(-e, (15, 1))]) + 0.001 * rng.standard_normal((615, 32))
        x = (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32).astype(float)
        y = np.concatenate([x, np.zeros((615, 1))], 1)
        per = [sum(np.isin(h.codes(h.cells(y[:600], t)[0], t), h.probes(y[i:i + 1], t)).sum() for t in range(A.TABLES)) for i in range(600, 602)]
        if not any(per):
            break
    per = [sum(np.isin(h.codes(h.cells(y[:600], t)[0], t), h.probes(y[i:i + 1], t)).sum() for t in range(A.TABLES)) for i in range(600, 615)]
    assert min(per) == 0
    got = defaultdict(list)
    for r in A.nearest(vectors(spark, [(i, v.tolist(), "") for i, v in enumerate(x)]), F.col("vec_id") >= 600).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    want = {q: A.brute_force(np.arange(615), x, q, x[q])[0].tolist() for q in range(600, 615)}
    assert {q: len(v) for q, v in got.items()} == {q: 20 for q in want}
    assert all([v for _, v in sorted(got[q])] == want[q] for q, n in zip(want, per) if n == 0)


def test_neighbours_ties_unusable_vectors_and_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 16)
    nan, inf = float("nan"), float("inf")
    data = [(i, [1.0, 2.0, 0.5], "") for i in range(1, 90)] + [(i, [3.0, 0.1 * i, -1.0], "") for i in range(100, 120)]
    data += [(200, None, ""), (201, [], ""), (202, [0.0, 0.0, 0.0], ""), (203, [1.0, nan, 0.0], ""), (204, [inf, 0.0, 0.0], ""),
             (205, [1.0, None, 0.0], ""), (206, [1.0, 2.0], ""), (None, [1.0, 1.0, 1.0], ""), (40, [1.0, 2.0, 0.5], "")]
    out = A.nearest(vectors(spark, data), F.col("vec_id").isin(20, 40, 200, 202, 206, 110), k=5).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    assert set(got) == {20, 40, 110}
    near = {i: sum(a * b for a, b in zip(v, [1.0, 2.0, 0.5])) for i, v, _ in data if i and v and len(v) == 3 and i < 200}
    want = sorted((i for i in near if i != 20), key=lambda i: (-np.float32(near[i]), i))[:5]
    assert got[20] == want
    assert all(len(v) == 5 for v in got.values())


def test_neighbours_of_few_and_none(spark):
    two = A.nearest(vectors(spark, [(20, [1.0, 0.0], ""), (1, [0.5, 0.5], "")]), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in two] == [(20, 1, 1, 0.5)]
    assert A.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_missed_is_the_share_of_rows_at_a_distance_in_no_bucket():
    h, rng = A.Hasher(48), np.random.default_rng(3)
    q = rng.standard_normal((1, 49))
    q /= np.sqrt((q * q).sum())
    for distance in (0.4, 0.8, 1.2):
        miss = np.zeros(A.PROBES)
        want = np.zeros(A.PROBES)
        for seed in range(60):  # the chance is over the draw of the projections
            h.a = np.random.default_rng(seed).standard_normal(h.a.shape)
            e = rng.standard_normal((200, 49))
            x = q + distance * e / np.sqrt((e * e).sum(1, keepdims=True))
            first = np.full(200, A.PROBES)
            orders = [h.order(q, t) for t in range(A.TABLES)]
            for t, (_, codes, _) in enumerate(orders):
                place = {int(c): i for i, c in enumerate(codes[0])}
                first = np.minimum(first, [place.get(int(c), A.PROBES) for c in h.codes(h.cells(x, t)[0], t)])
            miss += 1 - np.cumsum(np.bincount(first, minlength=A.PROBES + 1)[:A.PROBES]) / 200
            want += A.missed(orders, np.array([distance]))[0]
        assert np.abs(miss - want).max() / 60 < 0.04


def test_clustered_vectors_are_found_among_half_of_the_rows(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 64)) / 8
    x = centres[rng.integers(0, 40, 2400)] + 0.4 * rng.standard_normal((2400, 64)) / 8
    x = (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32).astype(float)
    got = defaultdict(dict)
    for r in A.nearest(vectors(spark, [(i, v.tolist(), "") for i, v in enumerate(x)]), F.col("vec_id") % 20 == 0).collect():
        got[r.query_id][r.vec_id] = r.score
    ids = np.arange(2400)
    recall = [len(set(got[q]) & set(A.brute_force(ids, x, q, x[q])[0].tolist())) / 20 for q in range(0, 2400, 20)]
    assert len(got) == 120 and np.mean(recall) >= 0.9, np.mean(recall)
    h, y, share = A.Hasher(64), np.concatenate([x, np.zeros((2400, 1))], 1), []
    codes = [h.codes(h.cells(y, t)[0], t) for t in range(A.TABLES)]
    for q in got:  # both turns' buckets; the final k-th score asks for no more than the first turn's did
        orders = [h.order(y[q:q + 1], t) for t in range(A.TABLES)]

        def seen(upto):
            return np.any([np.isin(c, o[1][0, :upto]) for c, o in zip(codes, orders)], 0)

        score = np.sort(A.exact(x, x[q][None])[seen(A.FIRST) & (ids != q)])
        assert len(score) >= 20
        distance = np.sqrt(2 - 2 * score[-20])
        upto = max(A.FIRST, int((A.missed(orders, np.array([distance])) > A.MISS).sum()) + 1)
        assert set(got[q]) <= set(ids[seen(upto)].tolist())
        share.append(seen(upto).mean())
    assert np.mean(share) <= 0.5, np.mean(share)


def test_probes_go_by_estimated_success():
    h = A.Hasher(4)
    q = np.random.default_rng(0).standard_normal((3, 5))
    cells, place = h.cells(q, 1)
    codes = h.probes(q, 1)
    for i in range(3):
        cost = {}
        for step in itertools.product((0, -1, 1), repeat=A.HASHES):
            c = sum((0.0, (1 - place[i, j]) ** 2, place[i, j] ** 2)[s] for j, s in enumerate(step))
            cost[int(h.codes(cells[i] + np.array(step), 1))] = c
        seen = [cost[int(c)] for c in codes[i]]
        assert np.allclose(seen, sorted(cost.values())[:A.PROBES]) and codes[i, 0] == h.codes(cells[i], 1)
