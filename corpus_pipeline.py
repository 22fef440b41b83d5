"""Corpus preparation as stages over ``documents``; each stage is written and read back before the next, and what it
stored on its way is deleted then."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from fiscalgrove.llm import decontaminate, mixing, pii, quality, similar
from fiscalgrove.llm.shared import settled, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 alike on five-word shingles) stays: that of the smallest id."""
    return similar.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark passage occurs go."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; every document stays."""
    return pii.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is mixed to the sources' target weights; rows are draws, with their shard and place."""
    return mixing.mixed_documents(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("mixture", mixture)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
