"""The corpus pipeline: five text operators over ``documents``, each on what the last one kept.

Cases: a null text has no words, so the quality rules reject it with other short texts; null ids are
documents like others, and of equal texts the one with the smallest id stays; rows with one id and
different texts are documents of their own; a document whose whole text is a repeated passage stays, with
an empty text, and the mix takes it as often as its hash says, with no words; without labels of good quality all
ratios are 0 and the base rules decide alone; an empty table gives an empty result. The stages keep columns they do not
know.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pointlake.llm import bpe, mixing, near_dedup, quality_rules, suffix_dedup
from pointlake.llm.common import table, written

# Passages of over 50 words are 240 bytes or longer, but for those of unusually short words.
PASSAGE_BYTES = 240

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality_rules.passing(docs, table(spark, sf_dir, "labels").where("quality = 1"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every class of near-duplicates."""
    return near_dedup.representatives(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that stand more than once out of the texts; every document stays."""
    return suffix_dedup.without_repeats(docs, length=PASSAGE_BYTES)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix does."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return bpe.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

# Hash functions, suffix sorting and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
