"""Suffix dedup and the n-gram join against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeflow.llm import ngram_join as N
from surgeflow.llm import repeats as R
from surgeflow.llm import suffix_dedup as S
from surgeflow.llm.common import Workspace
from surgeflow.llm.components import connected_components


def sets_of(text):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {b" ".join(w)}


def brute_components(pairs):
    """{row: (size, smallest id reachable)} for (id, text) rows; a null id counts as the largest."""
    sets = [sets_of(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if c and 100 * c >= 80 * (len(a) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        least[find(i)] = min(least.get(find(i), N.NO_ID), N.NO_ID if d is None else d)
    return [(d, len(s), None if (m := least[find(i)]) == N.NO_ID else m) for i, ((d, _), s) in enumerate(zip(pairs, sets))]


def ordered(rows):
    return sorted(rows, key=repr)


def test_suffix_dedup_matches_brute_force(docs, rows, ws):
    marks, blocks = S.removed_spans(docs, ws)
    got = {r.doc_id: tuple(r)[1:] for r in S.digest(S.strip(blocks, marks)).collect()}
    want = S.brute_force({r[0]: r[1] for r in rows})
    assert got == want
    assert sum(w[1] for w in want.values()) > 5000


def test_suffix_dedup_keeps_rows_and_columns(odd, ws):
    marks, blocks = S.removed_spans(odd, ws)
    out = R.as_rows(S.strip(blocks, marks, keep_row=True), odd.columns, F.col("kept_text"))
    assert out.columns == odd.columns
    assert ordered(map(tuple, out.collect())) == ordered(map(tuple, odd.collect()))


def test_equal_ids_do_not_remove_each_other(spark, ws):
    t = "q" * 10 + "".join(map(str, range(60)))
    marks, blocks = S.removed_spans(spark.createDataFrame([(5, t), (5, t), (None, t), (None, t), (9, t)], "doc_id long, text string"), ws)
    got = ordered((r.doc_id, r.n_removed) for r in S.digest(S.strip(blocks, marks)).collect())
    assert got == ordered([(5, 0), (5, 0), (9, len(t)), (None, len(t)), (None, len(t))])


def test_keys_that_begin_alike_are_split_over_ranges(spark, ws):
    rng = random.Random(4)

    def unit():
        return "a" * 17 + "".join(rng.choice("bcdefgh") for _ in range(5))

    shared = ["".join(unit() for _ in range(60)) for _ in range(40)]
    data = [(i, shared[i % 40] + "".join(unit() for _ in range(20))) for i in range(160)]
    many = spark.createDataFrame([(i, "".join(unit() for _ in range(80))) for i in range(3000)], "doc_id long, text string")
    with Workspace(spark, "many") as w:
        cuts = S.splitters(R.write_blocks(many, w), 24, w)
    assert cuts == sorted(set(cuts)) and all(len(c) == S.GRAM for c in cuts)
    assert max(sum(c[:8] == k for c in cuts) for k in {c[:8] for c in cuts}) >= 5, cuts
    marks, blocks = S.removed_spans(spark.createDataFrame(data, "doc_id long, text string"), ws)
    got = {r.doc_id: tuple(r)[1:] for r in S.digest(S.strip(blocks, marks)).collect()}
    assert got == S.brute_force(dict(data)) and sum(g[1] for g in got.values()) > 100_000


@pytest.mark.parametrize("ahead", [1, 7, 128])
def test_loser_tree_merges_by_common_prefixes(monkeypatch, ahead):
    monkeypatch.setattr(S, "AHEAD", ahead)
    rng = np.random.default_rng(3)
    for t in range(40):
        runs = []
        for _ in range(rng.integers(1, 10)):
            rows = np.zeros((rng.integers(1, 50), S.ROW), np.uint8)
            rows[:, :S.WINDOW] = rng.integers(0, 2, (len(rows), S.WINDOW)) if t % 2 else \
                rng.integers(0, 3, (len(rows), 1)) + np.arange(S.WINDOW) // rng.integers(1, 49)
            rows[:, S.WINDOW] = S.WINDOW
            rows = rows[S._order(rows)]
            runs.append((rows, S._shared(rows[:, :S.WINDOW])))
        order = S.merge_order(runs)
        merged = [bytes(r) for r in np.concatenate([r for r, _ in runs])[order][:, :S.WINDOW]]
        assert sorted(order.tolist()) == list(range(len(order))) and merged == sorted(merged)


def test_runs_travel_front_coded():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 2, (200, S.ROW)).astype(np.uint8)
    rows[:, S.WINDOW] = rng.integers(24, 51, 200)
    for i, n in enumerate(rows[:, S.WINDOW]):
        rows[i, n:S.WINDOW] = 0
    rows = rows[S._order(rows)]
    run = S.Run(rows, np.arange(200), np.arange(200), np.arange(200) * 7, np.arange(200, dtype=np.int32))
    back, lcp = S.Run.unpack(run.pack())
    assert (back.rows == rows).all() and (back.rid == run.rid).all() and (lcp == S._shared(rows[:, :50])).all()


def test_anchors_depend_on_content_only():
    rng = np.random.default_rng(5)
    shared = rng.integers(97, 101, 400).astype(np.uint8)
    found = []
    for lead in (0, 13, 700):
        data = np.concatenate([rng.integers(97, 123, lead).astype(np.uint8), shared])
        at = set()
        for _, p0, p1, x, _ in S.anchored_runs(data, np.array([0, len(data)])):
            for a, b, c in zip(p0, p1, x):
                at |= {(p - lead, c - lead) for p in range(a, b + 1) if p >= lead}
        found.append(at)
    assert found[0] == found[1] == found[2] and len(found[0]) == 351


def test_long_texts_are_cut_into_overlapping_pieces(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(9000), np.uint8)
    whole = [np.concatenate(c) for c in zip(*S.anchored_runs(data, np.array([0, len(data)])))]
    monkeypatch.setattr(S, "LONGEST", 2048)
    monkeypatch.setattr(S, "CHUNK_BYTES", 1024)
    cut = [np.concatenate(c) for c in zip(*S.anchored_runs(data, np.array([0, len(data)])))]

    def windows(c):
        return {(p, x) for a, b, x in zip(c[1], c[2], c[3]) for p in range(a, b + 1)}

    assert windows(cut) == windows(whole)


def test_ngram_join_matches_brute_force(docs, rows, ws):
    found, blocks = N.ngram_join(docs, ws)
    got = ordered(map(tuple, N.digest(found).collect()))
    assert got == ordered(brute_components([(r[0], r[1]) for r in rows]))
    kept = [r.doc_id for r in R.as_rows(N.representatives(found, blocks), docs.columns).collect()]
    assert sorted(kept) == sorted({c if c is not None else d for d, _, c in got})


def test_ngram_join_odd_rows(odd, ws):
    found, blocks = N.ngram_join(odd, ws)
    want = brute_components([(r.doc_id, r.text) for r in odd.collect()])
    assert ordered(map(tuple, N.digest(found).collect())) == ordered(want)
    kept = R.as_rows(N.representatives(found, blocks), odd.columns)
    assert kept.columns == odd.columns and kept.count() == 4  # one "alpha" row, three without words


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_group_of_near_copies(spark, ws, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    data = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        data.append((i, " ".join(w)))
    found, _ = N.ngram_join(spark.createDataFrame(data, "doc_id long, text string").repartition(4), ws)
    assert ordered(map(tuple, N.digest(found).collect())) == ordered(brute_components(data))


def brute_links(rows):
    """Per row: its number of links."""
    sets = [sets_of(t) for _, t in rows]
    return [sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= 80 * len(a | b))
            for i, a in enumerate(sets)]


@pytest.mark.parametrize("which", ["docs", "odd", "nothing"])
def test_every_link_is_counted(which, request, ws):
    table = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    found, pairs, _ = N.ngram_links(table, ws)
    got = found.select("ord", "n_links", "class").collect()
    none = N.NO_ID
    assert (sorted((r.ord, r.n_links) for r in got)
            == sorted((none if d is None else d, n) for (d, _), n in zip(rows, brute_links(rows))))
    size = {}
    for r in got:
        size[r["class"]] = size.get(r["class"], 0) + 1
    between = sum(size[p.a] * size[p.b] for p in pairs.collect())
    assert sum(r.n_links for r in got) == 2 * between + sum(n * (n - 1) for n in size.values())


@pytest.mark.parametrize("percent", [50, 80, 97, 100])
def test_bands_of_sizes_lose_no_pair(spark, percent):
    sizes = [*range(1, 130), *(5 ** i * 4 ** j for i in range(6) for j in range(6))]
    members = spark.createDataFrame([(i, n, n, 0, i, 1) for i, n in enumerate(sizes)],
                                    "cid long, n long, r long, pos long, root long, token long")
    got = {(p.a, p.b) for p in N.open_pairs(members, percent).collect()}
    assert got == {(i, j) for i, n in enumerate(sizes) for j, m in enumerate(sizes)
                   if i < j and min(n, m) * 100 >= max(n, m) * percent}


@pytest.mark.parametrize("n", [3, 5, 40, 147])
def test_prefix_filter_under_every_order(n):
    rng = np.random.default_rng(n)
    held = rng.integers(2, 9, n).astype(np.uint32)
    tokens = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))[:n]
    keep = N.needed(n, 80)
    other = np.sort(rng.permutation(len(tokens))[:keep])
    for a, b in zip(N.prefixes(tokens, held, n, 80), N.prefixes(tokens[other], held[other], keep, 80)):
        assert set(a.tolist()) & set(b.tolist())


def test_components_of_a_chain_a_star_and_loops(spark, ws):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 30)] + [(3, 3), (900, 899), (899, 900)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long"), ws, "t").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 7 for k in range(7, 30)}, 899: 899, 900: 899}
    none = connected_components(spark.createDataFrame([], "a long, b long"), ws, "e")
    assert none.collect() == []


def test_empty_tables(nothing, ws, spark):
    from surgeflow.llm.common import Workspace
    marks, blocks = S.removed_spans(nothing, ws)
    assert S.digest(S.strip(blocks, marks)).collect() == []
    with Workspace(spark, "empty") as other:
        found, blocks = N.ngram_join(nothing, other)
        assert N.digest(found).collect() == []


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 1000):
        v = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
        assert (R.unpack(R.pack(v)) == v).all()


def test_word_hashes_split_as_bytes_do(rows):
    for _, text, *_ in rows:
        b = (text or "").encode()
        h, first = N.word_hashes(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert first[1] - first[0] == len(b.split())
    assert hashlib.sha256(b"").hexdigest()


def test_blocks_without_a_repeated_anchor(spark, ws):
    """Neither runs nor marks: texts that share nothing, and none at all."""
    rng = np.random.default_rng(8)
    texts = {i: bytes(rng.integers(97, 123, 400).astype(np.uint8)).decode() for i in range(5)} | {7: None, 8: ""}
    marks, blocks = S.removed_spans(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), ws)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.strip(blocks, marks)).collect()}
    assert got == S.brute_force(texts)


def test_repeated_keys_in_slices(spark, ws, docs):
    """The key space cut into many slices gives what one slice gives."""
    def answered(at, slice_keys):
        blocks = R.write_blocks(docs, at).withColumn("block", F.col("rid") % 4)
        found = R.repeated_keys(blocks, S.anchor_sets, 40, at, slice_keys).groupBy("block").agg(F.collect_list(F.struct("keys", "counts")).alias("r"))
        return {r.block: sorted((k, c) for x in r.r for k, c in zip(R.unpack(x.keys).tolist(), R.expand(x.counts, np.uint32).tolist()))
                for r in found.collect()}

    with R.Workspace(spark, "one") as one:
        whole = answered(one, 1 << 20)
    cut = answered(ws, 7)
    assert whole == cut and sum(map(len, whole.values())) > 100
