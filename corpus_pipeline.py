"""The corpus pipeline: each stage works on the documents that the stage before kept.

Quality rules drop what they reject; of near-duplicates (fingerprints of three-word shingles that chains of at most three
differing bits join) the document with the smallest id stays; documents with a benchmark passage are dropped; secrets are replaced by their kind; what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from simsearch.llm import decontaminate, packing, quality, secrets, simhash
from simsearch.llm.common import shared_folder, table
from simsearch.session import ship_package

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.digest(packing.pack(docs, packing.default_tokenizer()))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
