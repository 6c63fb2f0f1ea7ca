"""From raw documents to shuffled shards: each stage takes what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlens.llm import decontamination, mixing, ngram_join, quality, sharding
from postlens.llm.common import keep, table


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their domains, languages and sources ask for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it; places do not depend on how the rows are stored."""
    placed = sharding.sharded(docs.withColumn("_crc", sharding.text_crc()), ["doc_id", "_crc"], sharding.SHARDS)
    return placed.drop("_crc")


STAGES = [
    ("quality classifier", accept),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: The classifier can't be written in SQL; the pipeline is tested against a version of its own without Spark.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
