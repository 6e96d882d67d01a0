"""Training-corpus pipeline: language ID, quality rules, near duplicates,
benchmark decontamination, packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return
the columns of ``documents``. :func:`run` writes each stage's result to the
shared folder and hands the written table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyscore.llm import decontaminate, jaccard, langid, pack, quality
from skyscore.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language that the model is sure of, go."""
    return langid.known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Short, repetitive or abnormal documents go."""
    return quality.good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least id."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in sequences of 2048 tokens."""
    return pack.pack(docs, pack.tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("decontaminate", decontaminated),
    ("pack", packed),
]
#: a trained language model and a tokenizer decide, so there is no SQL for it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
