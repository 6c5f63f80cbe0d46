"""From raw documents to packed sequences: each stage reads what the one before has written.

toxicity       documents whose score is at least 0.5 go
exact_dedup    of equal texts the row with the largest doc_id stays
near_dedup     of documents linked by at least 80 % of their five-word shingles one stays
mixing         rows are repeated or left out until the sources meet their target weights
packing        token pieces of the mixture in sequences of 4096
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from hourline.llm.common import ready, table
from hourline.llm.exact_dedup import deduplicate
from hourline.llm.minhash import drop_near_duplicates
from hourline.llm.mixing import taken
from hourline.llm.packing import pack
from hourline.llm.toxicity import drop_toxic
from hourline.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(ready(spark), sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs, "pipeline_digest_index")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return drop_near_duplicates(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return taken(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ready(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing),
]

# Nearest neighbours, components and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; every stage's rows are written to the shared folder and read again."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
