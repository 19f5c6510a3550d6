"""Documents to packed training sequences, in five stages.

Every stage reads what its predecessor kept. Quality rules drop failing
documents, exact and near duplicates leave one of each group, mixing repeats or
drops documents by weight, and packing tells which tokens lie in which sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qualityforge.llm import crf_quality, exact_dedup, mixing, packing, prefix_join
from qualityforge.llm.queries import CORPUS_MIX, corpus_sizes, packable, table
from qualityforge.llm.staging import staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return crf_quality.keep_good(docs, crf_quality.train(docs, table(spark, sf_dir, "labels")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies by shingles of five words at 0.8; op3 alone is bound to other values."""
    return prefix_join.keep_first(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, corpus_sizes(docs), CORPUS_MIX)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(packable(docs))


STAGES = [
    ("quality_rules", good_quality),
    ("exact_dedup", distinct_texts),
    ("ngram_jaccard_join", distinct_contents),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]

# A trained line model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
