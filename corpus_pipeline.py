"""A training corpus in five stages, each reading what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnwright.llm import bpe, decontaminate, pii, simhash, toxicity
from churnwright.llm.common import table
from churnwright.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon rejects go."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with a similarity of 0.8 or more in shingles of five words the document with the smallest id stays."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold benchmark windows in a twentieth of their words or more."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    return pii.redact(docs, pii.learn(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text decoded from them.

    The heap of an executor is full of what earlier stages left, so the encoders keep half of what they usually do.
    """
    return bpe.round_trip(docs, *bpe.public_ranks(), max_moves=bpe.MAX_MOVES // 2)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("tokens", encode),
]

#: The learned stages have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
