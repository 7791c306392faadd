"""A training corpus from raw documents, in stages that each hand on a written table.

Quality rules and language identification drop documents, of each group of near
copies one document stays, secrets are replaced by a mark, and what is left is packed
into token sequences. Each stage is judged on the documents that reach it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from siglake.llm import langid, near_dup, packing, quality, secret_scan
from siglake.session import configure, shared_folder


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the fences of their language and source."""
    return quality.kept(docs)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a wide margin."""
    return langid.accepted(docs)


def by_similarity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, on five words at 80 percent."""
    return near_dup.deduplicated(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", by_quality),
    ("language ID", by_language),
    ("near-duplicates", by_similarity),
    ("secret scans", without_secrets),
    ("packing", packed),
]

# Sketches, compression and tokenizers have no SQL; the tests use a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of the corpus; each stage but the last is written to the shared folder."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
