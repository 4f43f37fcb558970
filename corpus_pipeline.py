"""The training-data pipeline: five stages over ``documents``, each with its decisions applied.

A stage takes ``(spark, docs, sf_dir)``, where ``docs`` is what the stage before kept, and returns documents with the
same columns; the last one returns the shard manifest.

Defined cases, for every stage: an empty table gives an empty result; documents without an id or with the id of another are documents of their
own, and stay apart; null and empty texts are clean, have no copies and hold no passage, so they reach the mixture, which takes no document
without words; equal rows are one document to the second stage (the others go) and share their copies in the mixture; further
columns, also ones named as an operator's own, are kept to the last stage, which reads id and text only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, jaccard, mixing, sharding, toxicity
from corpusloom.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.without_toxic(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mixture takes them."""
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document of the mixture, with its shard and its place there."""
    return sharding.shard_manifest(docs, shards=16)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        scratch = Scratch(spark)
        docs = scratch.table(stage(spark, docs, sf_dir))
        before.clear()
        before = scratch
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained models and hashed draws are not expressible in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
