"""The pipeline's stages, one by one and as a whole."""

import re
from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline as P
from surgeflow.llm import suffix_dedup as S
from tests.llm.test_dedup_ops import brute_components
from tests.llm.test_layout_ops import SPACE, water

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    docs, path = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    frames = [docs]
    for name, stage in P.STAGES:
        path[name] = str(tmp_path / name)
        stage(spark, frames[-1], SF).write.parquet(path[name])
        frames.append(spark.read.parquet(path[name]))
    assert all(f.columns == columns for f in frames[:-1])
    every, good, single, cut, mixed = ([tuple(r) for r in f.collect()] for f in frames[:-1])

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r[0] for r in good}
    assert set(good) <= set(every)
    right = [(r[0] in kept) == bool(labels[r[0]]) for r in every if r[0] in labels]
    assert sum(right) / len(right) > 0.97

    group = {d: c for d, _, c in brute_components([(r[0], r[1]) for r in good])}
    assert sorted(r[0] for r in single) == sorted(set(group.values())) and set(single) <= set(good)

    want = S.brute_force({r[0]: r[1] for r in single})
    assert {r[0] for r in cut} == {r[0] for r in single}
    before = {r[0]: r[1] for r in single}
    for r in cut:
        if want[r[0]][1] == 0:
            assert r[1] == before[r[0]]
        else:
            assert len(r[1].encode()) <= want[r[0]][0] - want[r[0]][1] and r[4] == len(r[1])

    size = {r[0]: len(SPACE.findall(r[1])) for r in cut}
    by_source, got = Counter(), Counter()
    for r in cut:
        by_source[r[3]] += size[r[0]]
    for r in mixed:
        got[r[3]] += size[r[0]]
    goal = water(dict(by_source))
    longest = max(size.values())
    assert all(abs(got[s] - goal[s]) <= longest + 1 for s in goal)
    assert set(mixed) <= set(cut) and max(Counter(mixed).values()) <= 2

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = Counter((r.doc_id, tuple(r.ids)) for r in frames[-1].collect())
    assert ids == Counter((r[0], tuple(sp.encode(r[1]))) for r in mixed)


def test_run_leaves_one_result(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and not P._open
    assert re.fullmatch(r"\w+", P.STAGES[0][0]) and len(P.STAGES) == 5


def test_stages_take_nulls_and_nothing(spark, odd, nothing, tmp_path):
    for k, df in enumerate((odd, nothing)):
        for name, stage in P.STAGES:
            at = str(tmp_path / f"{k}-{name}")
            stage(spark, df, SF).write.parquet(at)
            if name != "encode":
                assert spark.read.parquet(at).columns == df.columns
