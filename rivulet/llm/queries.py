"""The registered queries of the subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import (
    chunks,
    decontamination,
    jaccard,
    licences,
    maxent,
    mixing,
    pieces,
    quality,
    repeats,
    resampling,
    toxicity,
    tries,
    warc,
)
from rivulet.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


@query("op1_toxicity")
def toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


@query("op2_source_mix", mixing.SQL)
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"))


@query("op3_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(read(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.trimmed(read(spark, sf_dir, "documents"))


@query("op5_chunk_dedup")
def chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.deduplicated(read(spark, sf_dir, "documents"))


@query("op6_warc_zstd", warc.SQL)
def warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read(spark, sf_dir, "pages"))


@query("op7_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op8_licences")
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(read(spark, sf_dir, "documents"))


@query("op9_maxent_lm")
def maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(read(spark, sf_dir, "documents"))


@query("op10_quality_rules", quality.SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents"))


@query("op11_prefix_trie", tries.SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(read(spark, sf_dir, "conversations"))


@query("op12_sentencepiece")
def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trip(read(spark, sf_dir, "documents"), model)


@query("op13_resampling", resampling.SQL)
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
