"""Corpus pipeline: the stages that turn documents into training tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from policyscan.llm import line_dedup, minhash, mixing, quality_rules, sentencepiece_codec
from policyscan.session import staging_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects low-quality documents and removes failing lines from the others."""
    return quality_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that many documents of a source share."""
    return line_dedup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings the sources to their target weights: documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return sentencepiece_codec.encode(docs, sentencepiece_codec.Model.load()).select("doc_id", "source", "lang", "ids")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("sentencepiece", encode),
]

# Near duplicates, the mix and the ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        target = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
