"""The training-text pipeline: each stage calls one operator of brieflight.llm, is written as Parquet and read again.

Every stage but the last returns the columns of documents; the last returns the ids of the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brieflight.llm import bpe, common, decontaminate, minhash, pii, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the ordinal classifier, fitted on the rated documents, rejects."""
    return quality.select_documents(docs, quality.model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five words, similarity 0.8."""
    return minhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of personal data in place of it."""
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and their decoding."""
    return bpe.encode_documents(docs, bpe.default_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", private_data),
    ("BPE encoding", encoding),
]

#: A fitted classifier and minima of hashes are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
