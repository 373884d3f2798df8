"""A corpus pipeline over `documents`: quality, language, near and exact repeats, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame that the next one reads. All but the last return the
columns of `documents`, with extra columns passed through. An empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard_join, language_id, packing, quality_rules, suffix_dedup
from tidemark.llm.common import saved
from tidemark.llm.queries import documents, vocabulary
from tidemark.session import tune


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy; rows with null text have no words and go."""
    tune(spark)
    return quality_rules.keep_quality(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one language makes up half or more; texts without a letter go."""
    tune(spark)
    return language_id.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Texts without words stay."""
    tune(spark)
    return jaccard_join.keep_one_per_component(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; a cut character goes as a whole, null texts stay null."""
    tune(spark)
    return suffix_dedup.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    tune(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeat_stage),
    ("packing", packing_stage),
]

# Byte-level language models, BPE and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
