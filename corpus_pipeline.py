"""The corpus pipeline: documents in, encoded training rows out.

Five stages, each (spark, docs, sf_dir) -> DataFrame over all that the stage
before kept; its result is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``:

1. ``quality``: the additive model, fitted on the labels in ``sf_dir``, drops
   what it scores below 0.5.
2. ``near_duplicates``: of each component of documents linked by five-word
   shingles at a similarity of 0.8, the row of the smallest id stays.
3. ``suffix_dedup``: bytes under 50-byte strings that also start in a document
   with a smaller id go (and what is left of a character cut apart); rows stay.
4. ``mix``: each document is repeated as often as the schedule takes its words,
   rounded: 0, 1 or 2 times.
5. ``encode``: piece ids of every text.

A stage's work tables live in the shared folder until the next stage starts,
when its result has been written and they are deleted. SQL cannot express the
model's fit, so ORACLE_SQL is None; tests hold each stage against brute force.
"""

from __future__ import annotations

import threading

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.llm import mixing, ngram_join, quality_gam, repeats, sentencepiece_codec, suffix_dedup
from surgeflow.llm.common import Workspace, small_batches

ORACLE_SQL = None


class _Open(threading.local):
    """Work folders that stages of this thread still read; runs beside each other in
    other threads leave them alone."""

    def __init__(self):
        self.spaces: list[Workspace] = []

    def __bool__(self) -> bool:
        return bool(self.spaces)

    def drop(self) -> None:
        while self.spaces:
            self.spaces.pop().drop()


_open = _Open()


def _workspace(spark: SparkSession, name: str) -> Workspace:
    """A stage's work folder; those of stages before are no longer read."""
    _open.drop()
    _open.spaces.append(Workspace(small_batches(spark), f"pipeline-{name}"))
    return _open.spaces[-1]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_gam.train(docs, small_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.score(docs, model, into="_score").where("_score >= 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, blocks = ngram_join.ngram_join(docs, _workspace(spark, "near"))
    return repeats.as_rows(ngram_join.representatives(found, blocks), docs.columns)


def dedup_suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marks, blocks = suffix_dedup.removed_spans(docs, _workspace(spark, "suffix"))
    rows = repeats.as_rows(suffix_dedup.strip(blocks, marks, keep_row=True), docs.columns, F.col("kept_text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else rows


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ws = _workspace(spark, "mix")
    blocks = repeats.write_blocks(docs, ws)
    taken = mixing.mix_sources(
        blocks.select(F.col("block").alias("home"), "rid", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
                      F.col("body").cast("string").alias("text")), ws, rid=F.col("rid"), carry=("home",))
    copies = taken.where("size > 0").withColumn("n", F.expr("(2 * taken + size) div (2 * size)")).where("n > 0")
    plan = copies.groupBy(F.col("home").alias("block")).agg(F.map_from_entries(F.collect_list(F.struct("rid", "n"))).alias("copies"))
    rows = blocks.join(plan, "block").withColumn("n", F.col("copies")[F.col("rid")]).where("n > 0")
    rows = rows.withColumn("_copy", F.explode(F.expr("sequence(1, n)")))
    return repeats.as_rows(rows, docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _open.drop()
    small_batches(spark)
    encoded = sentencepiece_codec.sentencepiece_codec(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("suffix_dedup", dedup_suffixes),
          ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder
    and the one before it deleted once it has been read."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    try:
        for name, stage in STAGES:
            here = Workspace(spark, f"pipeline-{name}")
            docs = here.write(stage(spark, docs, sf_dir), "rows")
            if before:
                before.drop()
            before = here
    finally:
        _open.drop()
    return docs
