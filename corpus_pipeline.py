"""A training-data pipeline over ``documents``: each stage keeps or changes rows, written and read again between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, minhash, mixing, quality_rules, secret_scan


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return quality_rules.good_documents(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; copies share 80 % of their five-word shingles.

    A pair at the threshold is missed with probability 0.0015, less above it.
    """
    gone = minhash.near_duplicates(docs, percent=80).filter("not kept")
    return common.keep_ids(docs, common.written(gone.select("doc_id"), "copies"), anti=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go; each row is judged by its own text, whatever its id."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    return secret_scan.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source_size, target, and how many words and copies of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("mixing", mixed),
]
#: The near-duplicate and randomness stages are checked against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.written(docs, f"stage{i}")
    return docs
