"""A training corpus from documents: five stages, each on all that its predecessor kept.

All stages but the last give the columns of documents, others of any name included. Null and empty texts are scored as
empty ones; those that stay link with nothing and are packed as their end id alone. Rows that repeat id and text are one
near-copy group; texts that share an id are decided one by one. Empty tables give no rows, and without labels toxicity and
quality keep all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import jaccard, pii, quality, toxicity
from cellweave.llm.common import durable, table
from cellweave.llm.queries import pack_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_copies", drop_near_copies), ("pii", redact_private), ("packing", pack)]

#: Learned models and library tokens are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
