"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgeflow.llm import best_fit_packing, filter_audit, fingerprint, hilbert_sharding, lexical_search, license_scan, mixing, multiprobe_ann, ngram_join, quality_gam, suffix_dedup, wordpiece_count
from surgeflow.llm import sentencepiece_codec as spc
from surgeflow.llm.common import Workspace, settled, small_batches


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op1") as ws:
        marks, blocks = suffix_dedup.removed_spans(table(spark, sf, "documents"), ws)
        return settled(suffix_dedup.digest(suffix_dedup.strip(blocks, marks)), "op1")


def op2_multiprobe_ann(spark: SparkSession, sf: str) -> DataFrame:
    return multiprobe_ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op3") as ws:
        return settled(mixing.mix_sources(table(spark, sf, "documents"), ws).drop("rid"), "op3")


def op4_quality_gam(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality_gam.digest(docs, quality_gam.train(docs, table(spark, sf, "labels")))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op5") as ws:
        return settled(license_scan.digest(*license_scan.scan_licences(table(spark, sf, "documents"), ws)), "op5")


def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return spc.digest(spc.sentencepiece_codec(table(spark, sf, "documents"), model))


def op7_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op7") as ws:
        return settled(fingerprint.fingerprints(table(spark, sf, "documents"), ws), "op7")


def op8_hilbert_sharding(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op8") as ws:
        order = hilbert_sharding.hilbert_order(table(spark, sf, "documents"), ws)
        return settled(hilbert_sharding.digest(hilbert_sharding.cut_runs(order, 16)), "op8")


def op9_wordpiece_count(spark: SparkSession, sf: str) -> DataFrame:
    return wordpiece_count.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op10") as ws:
        found, _ = ngram_join.ngram_join(table(spark, sf, "documents"), ws)
        return settled(ngram_join.digest(found), "op10")


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op11") as ws:
        return settled(lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ws), "op11")


def op12_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op12") as ws:
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
        packed = best_fit_packing.pack(table(spark, sf, "documents"), vocabulary, ws, keep_ids=False)
        return settled(best_fit_packing.digest(packed), "op12")


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    with Workspace(spark, "op13") as ws:
        return settled(filter_audit.audit(spark, f"{sf}/documents.parquet", table(spark, sf, "labels"), ws), "op13")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_multiprobe_ann": op2_multiprobe_ann,
    "op3_mixing": op3_mixing,
    "op4_quality_gam": op4_quality_gam,
    "op5_license_scan": op5_license_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_fingerprint": op7_fingerprint,
    "op8_hilbert_sharding": op8_hilbert_sharding,
    "op9_wordpiece_count": op9_wordpiece_count,
    "op10_ngram_join": op10_ngram_join,
    "op11_lexical_search": op11_lexical_search,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op3_mixing": mixing.ORACLE_SQL,
    "op10_ngram_join": ngram_join.ORACLE_SQL,
    "op11_lexical_search": lexical_search.ORACLE_SQL,
    "op13_filter_audit": filter_audit.ORACLE_SQL,
}
