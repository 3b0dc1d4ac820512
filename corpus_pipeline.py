"""From raw documents to packed sequences: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes all that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import exact_dedup, mixing, ngram_join, packing, quality
from wakeline.llm.common import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the adaptive thresholds go."""
    return quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.75 over five-word shingles, the smallest doc_id stays."""
    return ngram_join.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by raked weights."""
    return mixing.sample_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return packing.digests(packing.pack(docs))


STAGES = [("quality rules", quality_rules), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mix), ("packing", packed)]

#: Shingle joins and tokenisation are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
