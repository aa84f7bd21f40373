"""The corpus pipeline: documents in, encoded training mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from silverline.llm import bpe, jaccard_join, pii, quality_rules, source_mix
from silverline.llm.common import read
from silverline.session import checkpoint_root


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the rules reject go."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 on five-word shingles at 0.8: one document of each group stays."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: spans are replaced by their kind."""
    return pii.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the words that the mix takes, a row for each repeat."""
    return source_mix.materialise(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token ids, and the digests of the round trip."""
    return bpe.digests(docs, bpe.default_vocabulary(), ["doc_id", "source"])


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", private_data),
    ("source mix", mixing),
    ("BPE", encoding),
]

# Hashes, fitted trees and the vocabulary are beyond SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
