"""From raw documents to token ids: rules, boilerplate lines, near-duplicates, benchmark passages, encoding.

Each stage works on all that the one before has kept. The last returns a row of
token ids for each document that is left, the others the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from galewatch.llm import byte_bpe, decontaminate, line_dedup, quality_rules, simhash
from galewatch.llm.shared import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs certified on the labels."""
    return quality_rules.without_rejected(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that too many documents of their source hold."""
    return line_dedup.without_boilerplate(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and the digests of ids and decoded bytes."""
    return byte_bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", by_quality),
    ("line dedup", without_boilerplate),
    ("near-duplicates", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", token_ids),
]

ORACLE_SQL = None  # SQL expresses neither fingerprints nor merges; tests/llm compares run() with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the stored documents; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
