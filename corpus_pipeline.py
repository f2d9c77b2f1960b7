"""From raw documents to a training mix: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last
return the columns of `documents`; the last returns each document as often as the mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import decontamination, jaccard, mixing, repeats, toxicity
from rivulet.llm.tables import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity is more likely than not above the lowest grade go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that shingle similarity links, the one with the least doc_id stays."""
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes and of 50 words that stand elsewhere too are cut out of the texts; all documents stay."""
    return repeats.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, be it with other numbers or names, go."""
    return decontamination.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("source_mix", mix_sources),
]

# No SQL states a fitted model or a suffix order over a whole corpus; tests/llm checks each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
