"""A corpus through the stages of a training-data pipeline, each stage a table for the next.

Language ID rejects texts without a recognisable language; of similar documents one stays;
documents that share passages with the benchmark go; sources are mixed to their target weights;
what is left is dealt out to shards. Every stage but the last returns the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontamination, jaccard, language, mixing, sharding
from shelfwise.llm.store import materialise, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the texts that language ID rejects."""
    return language.accepted_documents(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that share a passage with the benchmark."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents left out, cut at the budget, or repeated."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row of the mix."""
    return sharding.shard_table(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("jaccard", one_of_each),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The first stage is a trained classifier, which SQL cannot express; tests hold every stage
#: against a plain computation instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with a table between each two."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
